"""Status views on a hand-made registry: zero counts, NULL vs 0 sums, per-table boards."""
import datetime as dt

from feedloom.operators import monitor as M


def _frames(spark):
    products = spark.createDataFrame([("P1", "One", "product_p1", True), ("P2", "Two", "product_p2", False)],
                                     "product_id string, title string, table_name string, schema_created boolean")
    history = spark.createDataFrame(
        [("P1", "a.csv", "completed", 5, 4, dt.datetime(2024, 1, 2)), ("P1", "b.csv", "error", 0, None, None),
         ("P1", "c.csv", "pending", None, None, None)],
        "product_id string, file_name string, status string, rows_processed long, rows_saved long, "
        "processing_completed timestamp_ntz")
    return products, history


def test_processing_status_and_stats(spark):
    products, history = _frames(spark)
    view = {r.product_id: r for r in M.processing_status(products, history).collect()}
    p1, p2 = view["P1"], view["P2"]
    assert (p1.total_files, p1.completed_files, p1.error_files, p1.pending_files) == (3, 1, 1, 1)
    assert (p1.total_rows_processed, p1.total_rows_saved) == (5, 4)
    assert p2.total_files == 0 and p2.total_rows_processed is None and p2.last_completed is None
    stats = {r.product_id: r for r in M.processing_stats(products, history).collect()}
    assert stats["P2"].total_rows == 0 and stats["P2"].total_saved == 0
    totals = M.status_totals(history).first()
    assert (totals.total_files, totals.completed_files, totals.total_rows_saved) == (3, 1, 4)


def test_progress_board_and_recent(spark):
    products, _ = _frames(spark)
    rows = spark.createDataFrame([("product_p1", 3, dt.datetime(2024, 1, 15, 11, 30)),
                                  ("product_p1", 7, dt.datetime(2024, 1, 15, 9, 0))],
                                 "table_name string, batch_number long, created_at timestamp_ntz")
    board = {r.product_id: r for r in M.progress_board(products, rows).collect()}
    assert (board["P1"].record_count, board["P1"].latest_batch) == (2, 7)
    assert (board["P2"].record_count, board["P2"].latest_batch, board["P2"].last_processed) == (0, 0, None)
    recent = M.recent_activity(rows, dt.datetime(2024, 1, 15, 12, 0)).collect()
    assert [(r.table_name, r.total_records, r.latest_batch) for r in recent] == [("product_p1", 1, 3)]
