import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import incremental as inc
from ledgerloom.operators.quality import RuleViolation
from ledgerloom.plans.incremental_orders import check_core, core_orders, load_batch, load_initial, run
from ledgerloom.sources.contracts import ORDER_LINES
from ledgerloom.sources.run_log import RunLog
from ledgerloom.sources.snapshots import PublishConflict, Snapshots
from ledgerloom.streaming.batch_intake import take_in
from tests import fixed_values as fv

KEY, VERSION = ORDER_LINES.key, "updated_at"
TIES = ["order_date", "customer_id", "product_id", "quantity", "unit_price"]


def dated(raw):
    """Initial lines carry no change time: midnight of their order date."""
    return raw.withColumn("updated_at", F.concat("order_date", F.lit(" 00:00:00")))


def typed(raw):
    return ORDER_LINES.require_batch(ORDER_LINES.typed(raw))


def totals(core):
    row = core.agg(
        F.count("*"), F.sum("quantity"), F.sum(F.col("quantity") * F.col("unit_price"))
    ).first()
    return row[0], row[1], float(row[2])


@pytest.fixture
def store(spark, tmp_path, table):
    made = Snapshots(spark, str(tmp_path / "store"))
    load_initial(made, dated(table(fv.INITIAL_ORDERS)))
    load_initial(made, dated(table(fv.GOOD_BATCH)))
    return made


def test_sequence_of_batches(spark, tmp_path, table, store):
    log = RunLog(spark, str(tmp_path / "runs"))
    assert core_orders(store).count() == 25
    steps = [
        # batch, staged, affected, inserted, updated, core rows, quantity, amount
        (fv.BATCH_1, 7, 5, 3, 2, 28, 59, 1274.08),
        (fv.BATCH_2, 7, 4, 2, 2, 30, 65, 1430.83),
        (fv.EDGE_BATCH, 3, 1, 1, 0, 31, 68, 1457.08),
        (fv.RESTART_BATCH, 3, 3, 2, 1, 33, 624, 8496.08),
        (fv.GOOD_RUN_BATCH, 4, 3, 3, 0, 36, 632, 8674.08),
        (fv.GOOD_RUN_BATCH, 4, 0, 0, 0, 36, 632, 8674.08),
    ]
    for text, staged, affected, inserted, updated, *core in steps:
        result = load_batch(store, log, lambda text=text: table(text))
        assert (result.staged_rows, result.affected_rows) == (staged, affected)
        assert (result.inserted_rows, result.updated_rows) == (inserted, updated)
        assert totals(core_orders(store)) == tuple(core)
        assert store.read("staging", ORDER_LINES.schema).count() == staged
    assert log.state().filter("status = 'SUCCESS'").count() == 6
    check_core(store)


def test_a_bad_batch_changes_nothing_and_can_be_repaired(spark, tmp_path, table, store):
    log = RunLog(spark, str(tmp_path / "runs"))
    before = totals(core_orders(store))
    with pytest.raises(RuleViolation, match="quantity_positive: 1"):
        load_batch(store, log, lambda: dated(table(fv.BAD_BATCH)))
    assert store.version == 2 and totals(core_orders(store)) == before
    with pytest.raises(ValueError, match="updated_at"):
        load_batch(store, log, lambda: table(fv.GOOD_BATCH))
    with pytest.raises(FileNotFoundError):
        run(store, log, str(tmp_path / "missing.csv"))
    states = [(r["status"], r["error_message"] is not None) for r in log.state().collect()]
    assert states == [("FAILED", True)] * 3
    path = tmp_path / "batch.csv"
    path.write_text(fv.RESTART_BATCH, encoding="utf-8")
    assert run(store, log, str(path)).affected_rows == 3
    assert core_orders(store).count() == 27


def test_a_failed_publish_leaves_the_old_tables(spark, tmp_path, table, store, monkeypatch):
    log = RunLog(spark, str(tmp_path / "runs"))
    before = totals(core_orders(store))

    def broken(tables, base=None):
        raise OSError("storage is gone")

    with monkeypatch.context() as patched:
        patched.setattr(store, "publish", broken)
        with pytest.raises(OSError):
            load_batch(store, log, lambda: table(fv.BATCH_1))
    assert totals(core_orders(store)) == before
    assert load_batch(store, log, lambda: table(fv.BATCH_1)).affected_rows == 5


def test_an_overtaken_load_fails_and_loses_nothing(spark, tmp_path, table, store):
    log = RunLog(spark, str(tmp_path / "runs"))

    def read():  # another writer publishes meanwhile
        load_batch(Snapshots(spark, store.root), log, lambda: table(fv.BATCH_1))
        return table(fv.BATCH_2)

    with pytest.raises(PublishConflict):
        load_batch(store, log, read)
    assert core_orders(store).count() == 28
    assert sorted(r["status"] for r in log.state().collect()) == ["FAILED", "SUCCESS"]
    assert load_batch(store, log, lambda: table(fv.BATCH_2)).affected_rows == 4


def test_the_first_error_goes_on_when_it_cannot_be_logged(spark, tmp_path, table, store, monkeypatch):
    log = RunLog(spark, str(tmp_path / "runs"))

    def broken(*args):
        raise OSError("log is gone")

    monkeypatch.setattr(log, "fail", broken)
    with pytest.raises(RuleViolation, match="quantity_positive: 1"):
        load_batch(store, log, lambda: dated(table(fv.BAD_BATCH)))


def test_a_lost_log_entry_keeps_the_published_data(spark, tmp_path, table, store, monkeypatch):
    log = RunLog(spark, str(tmp_path / "runs"))

    def broken(*args):
        raise OSError("log is gone")

    monkeypatch.setattr(log, "succeed", broken)
    with pytest.raises(OSError):
        load_batch(store, log, lambda: table(fv.BATCH_1))
    assert core_orders(store).count() == 28
    assert [r["status"] for r in log.state().collect()] == ["RUNNING"]


def test_initial_load_refuses_known_keys(table, store):
    with pytest.raises(RuleViolation, match="key_unique: 5"):
        load_initial(store, dated(table(fv.GOOD_BATCH)))
    assert core_orders(store).count() == 25


def test_only_touched_months_are_rewritten(spark, tmp_path, table):
    store, log = Snapshots(spark, str(tmp_path / "s")), RunLog(spark, str(tmp_path / "runs"))
    header = "order_id,line_id,order_date,customer_id,product_id,quantity,unit_price,updated_at\n"
    lines = "A,1,2026-01-05,,P,1,1,2026-01-05 00:00:00\nB,1,2026-02-05,,P,1,1,2026-02-05 00:00:00\n"
    load_initial(store, table(header + lines + "C,1,2026-03-05,,P,1,1,2026-03-05 00:00:00\n"))
    before = store.parts("core")
    # B moves from February to April, D is new in March.
    moved = "B,1,2026-04-05,,P,2,1,2026-02-06 00:00:00\nD,1,2026-03-06,,P,1,1,2026-03-06 00:00:00\n"
    load_batch(store, log, lambda: table(header + moved))
    after = store.parts("core")
    assert sorted(before) == ["core/2026-01", "core/2026-02", "core/2026-03"]
    assert sorted(after) == ["core/2026-01", "core/2026-03", "core/2026-04"]
    assert after["core/2026-01"] == before["core/2026-01"]
    core = core_orders(store).select("order_id", F.col("order_date").cast("string"), "quantity")
    assert sorted(tuple(r) for r in core.collect()) == [
        ("A", "2026-01-05", 1),
        ("B", "2026-04-05", 2),
        ("C", "2026-03-05", 1),
        ("D", "2026-03-06", 1),
    ]


def test_newer_wins_equal_and_older_are_ignored(table, rows):
    core = typed(table(fv.EDGE_BATCH))
    batch = typed(
        table(
            "order_id,line_id,order_date,customer_id,product_id,quantity,unit_price,updated_at\n"
            "O1001,1,2026-09-10,C001,P001,5,12.50,2026-09-18 08:00:00\n"
            "O4000,1,2026-09-19,C015,P008,7,79.00,2026-09-19 11:00:01\n"
            "O0800,1,2026-08-30,C020,P002,8,8.75,2026-09-19 12:29:59\n"
            "N1,1,2020-01-01,C020,P002,1,8.75,2026-09-01 00:00:00\n"
            "N1,1,2020-01-01,C020,P002,2,8.75,2026-09-02 00:00:00\n"
        )
    )
    classified = inc.classify_changes(core, batch, KEY, VERSION, TIES)
    assert rows(inc.change_report(classified)) == [("ignore", 2), ("insert", 1), ("update", 1)]
    merged = inc.upsert(core, batch, KEY, VERSION, TIES)
    assert rows(merged, "order_id", "quantity") == [("N1", 2), ("O0800", 3), ("O1001", 999), ("O4000", 7)]
    again = inc.classify_changes(merged, batch, KEY, VERSION, TIES)
    assert rows(inc.change_report(again)) == [("ignore", 4)]
    with pytest.raises(ValueError, match="repeated key in batch"):
        inc.upsert(core, batch, KEY, VERSION, TIES, dedup=False)


def test_order_of_batches_does_not_matter(table, rows):
    core = typed(dated(table(fv.INITIAL_ORDERS)))
    one, two = typed(table(fv.BATCH_1)), typed(table(fv.BATCH_2))

    def apply(*batches):
        result = core
        for batch in batches:
            result = inc.upsert(result, batch, KEY, VERSION, TIES)
        return rows(result)

    assert apply(one, two) == apply(two, one) == apply(one.unionByName(two)) == apply(one, two, one)


def test_keyed_update_delete_lookup_append(table, rows):
    core = typed(dated(table(fv.GOOD_BATCH)))
    fix = core.filter("order_id = 'O2001' AND line_id = 2").withColumn("quantity", F.lit(9))
    assert rows(inc.look_up(inc.update_by_key(core, fix, KEY, "quantity"), {"order_id": "O2001"}), "quantity") == [(2,), (9,)]
    assert inc.delete_by_key(core, fix, KEY).count() == 4
    assert inc.look_up(core, {"order_id": "O2003", "line_id": 2}).count() == 1
    assert inc.append_batch(core, fix.withColumn("note", F.lit("x"))).count() == 6


def test_files_are_taken_in_once(spark, tmp_path, store):
    log = RunLog(spark, str(tmp_path / "runs"))
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "a.csv").write_text(fv.BATCH_1, encoding="utf-8")
    for _ in range(2):
        take_in(store, log, str(inbox), str(tmp_path / "progress"))
    assert (core_orders(store).count(), log.state().count()) == (28, 1)
    (inbox / "b.csv").write_text(fv.BATCH_2, encoding="utf-8")
    take_in(store, log, str(inbox), str(tmp_path / "progress"), files_per_run=2)
    assert (core_orders(store).count(), log.state().count()) == (30, 2)
