"""The per-item aggregation as a file stream."""

from ratelens.streaming import current_item_stats, start_item_stats


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_matches_batch_and_restarts_cleanly(spark, tmp_path):
    src, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    src.mkdir()
    (src / "a.txt").write_text("1, 10, 4.0, 1\n2, 10, 2.0, 2\nbad line\n")
    (src / "b.txt").write_text("3, 11, 5.0, 3\n")
    q = start_item_stats(spark, str(src), out, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    assert rows(current_item_stats(spark, out)) == [(10, 3.0, 2), (11, 5.0, 1)]
    # a new file arrives; the restarted query continues from its checkpoint
    (src / "c.txt").write_text("4, 10, 6.0, 4\n")
    q = start_item_stats(spark, str(src), out, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    assert rows(current_item_stats(spark, out)) == [(10, 4.0, 3), (11, 5.0, 1)]
