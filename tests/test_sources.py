import logging
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.quality import RuleViolation
from ledgerloom.plans import line_amount
from ledgerloom.sources import parquet
from ledgerloom.sources.contracts import ORDER_LINES
from ledgerloom.sources.csv import read_csv, write_csv
from ledgerloom.sources.run_log import RunLog
from ledgerloom.sources.snapshots import PublishConflict, Snapshots
from tests import fixed_values as fv


def save(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_is_text_with_missing_words_as_null(spark, tmp_path, rows):
    path = save(tmp_path / "a.csv", '﻿id,name,note\n1,"a, ""b""",NA\n2,,nan\n3,null,x \n')
    df = read_csv(spark, path)
    assert df.dtypes == [("id", "string"), ("name", "string"), ("note", "string")]
    assert rows(df) == [("1", 'a, "b"', None), ("2", None, None), ("3", None, "x ")]


def test_csv_missing_empty_and_header_only(spark, tmp_path, caplog):
    with pytest.raises(FileNotFoundError):
        read_csv(spark, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError, match="no readable data"):
        read_csv(spark, save(tmp_path / "zero.csv", ""))
    header = save(tmp_path / "header.csv", "order_id,quantity\n")
    with pytest.raises(ValueError, match="empty"):
        read_csv(spark, header)
    with caplog.at_level(logging.WARNING):
        assert read_csv(spark, header, on_empty="warn").columns == ["order_id", "quantity"]
    assert "empty" in caplog.text
    assert read_csv(spark, header, on_empty="pass").count() == 0


def test_csv_with_swapped_headers_or_extra_fields_raises(spark, tmp_path, rows):
    folder = tmp_path / "mixed"
    folder.mkdir()
    save(folder / "a.csv", "order_id,quantity,unit_price\n1,2,9.5\n")
    save(folder / "b.csv", "order_id,quantity,unit_price\n2,3\n")
    assert rows(read_csv(spark, str(folder))) == [("1", "2", "9.5"), ("2", "3", None)]
    save(folder / "c.csv", "order_id,unit_price,quantity\n3,9.5,4\n")
    with pytest.raises(ValueError, match="headers"):
        read_csv(spark, str(folder))
    long = save(tmp_path / "long.csv", 'a,b\n1,2\n1,2,LOST\n1,"x,y"\n1,,\n')
    with pytest.raises(ValueError, match="2 rows have more fields"):
        read_csv(spark, long)


def test_csv_with_a_line_break_in_quotes(spark, tmp_path, rows):
    path = save(tmp_path / "q.csv", 'id,note\n1,"first, line\nsecond ""line"""\n2,x\n')
    assert rows(read_csv(spark, path)) == [("1", 'first, line\nsecond "line"'), ("2", "x")]


def test_csv_files_are_shared_by_tasks_unless_quotes_span_lines(spark, tmp_path, rows):
    folder = tmp_path / "many files"
    folder.mkdir()
    lines = [f'{i},"a ""quoted"" name, {i}"' for i in range(3000)]
    save(folder / "large.csv", "id,note\n" + "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        alone = read_csv(spark, str(folder))
        assert alone.rdd.getNumPartitions() > 5 and alone.count() == 3000
        save(folder / "broken lines.csv", 'id,note\n9000,"first\n9001,second"\n9002,x\n')
        both = read_csv(spark, str(folder))
        assert both.rdd.getNumPartitions() > 5 and both.count() == 3002
        assert rows(both.where("id >= 2999")) == [("2999", 'a "quoted" name, 2999'), ("9000", "first\n9001,second"), ("9002", "x")]
        save(folder / "z.csv", "note,id\nx,1\n")
        with pytest.raises(ValueError, match="differ in their headers"):
            read_csv(spark, str(folder))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_bytes_that_are_not_utf8_raise(spark, tmp_path):
    (tmp_path / "latin.csv").write_bytes(b"id,name\n1,caf\xe9\n2,x\n")
    with pytest.raises(ValueError, match="1 lines of file:.*latin.csv are not UTF-8"):
        read_csv(spark, str(tmp_path / "latin.csv"))
    good = save(tmp_path / "good.csv", "id,name\n1,caf\u00e9 \ufffd\n")
    assert read_csv(spark, good).first()["name"] == "caf\u00e9 \ufffd"


def test_csv_with_a_repeated_header_name_raises(spark, tmp_path):
    for header in ("a,b,a", "a,b,A"):
        with pytest.raises(ValueError, match="names columns more than once: a"):
            read_csv(spark, save(tmp_path / "twice.csv", f"{header}\n1,2,3\n"))


def test_sinks_overwrite_and_read_back(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    for _ in range(2):
        write_csv(df, str(tmp_path / "deep" / "csv"))
        parquet.write_parquet(df, str(tmp_path / "deep" / "parquet"))
    assert rows(read_csv(spark, str(tmp_path / "deep" / "csv"))) == [("1", "a"), ("2", None)]
    assert rows(parquet.read_parquet(spark, str(tmp_path / "deep" / "parquet"))) == rows(df)


def test_line_amount_job(spark, tmp_path, rows):
    source = save(tmp_path / "s.csv", "order_id,quantity,unit_price,extra\n1,2,35.50,x\n2,1,20.00,y\n")
    line_amount.run(spark, source, str(tmp_path / "out"))
    written = read_csv(spark, str(tmp_path / "out"))
    assert rows(written, "order_id", "extra", "total_amount") == [("1", "x", "71.0"), ("2", "y", "20.0")]
    decimals = save(tmp_path / "d.csv", "quantity,unit_price\n2.0,3\n1.5,2\n")
    line_amount.run(spark, decimals, str(tmp_path / "out3"))
    assert rows(read_csv(spark, str(tmp_path / "out3"))) == [("1.5", "2.0", "3.0"), ("2", "3.0", "6.0")]
    lacking = save(tmp_path / "m.csv", "order_id,quantity\n1,2\n")
    with pytest.raises(ValueError, match="unit_price"):
        line_amount.run(spark, lacking, str(tmp_path / "out2"))


def test_contract_types_and_violations(table, rows):
    raw = table(
        "order_id,line_id,order_date,customer_id,product_id,quantity,unit_price,updated_at\n"
        "O1,1,2026-09-10,,P1,2,12.345,2026-09-10 00:00:00\n"
        "O2,x,2026-09-10,C1,P1,0,-1,2026-09-10 00:00:00\n"
        "O345678901234567890123,1,2026-09-10,C1,,2,1,\n"
    )
    typed = ORDER_LINES.typed(raw)
    assert typed.select("unit_price").first()[0] == Decimal("12.35")
    broken = {r[0]: r[1] for r in ORDER_LINES.batch_violations(typed).collect() if r[1]}
    assert broken == {
        "line_id_readable": 1,
        "line_id_not_null": 1,
        "product_id_not_null": 1,
        "updated_at_not_null": 1,
        "order_id_length": 1,
        "quantity_positive": 1,
        "unit_price_not_negative": 1,
    }
    with pytest.raises(RuleViolation, match="quantity_positive: 1"):
        ORDER_LINES.require_batch(typed)
    with pytest.raises(ValueError, match="updated_at"):
        ORDER_LINES.typed(table(fv.GOOD_BATCH))


def test_contract_finds_repeated_keys_in_a_table(table):
    with_times = table(fv.GOOD_RUN_BATCH)
    core = ORDER_LINES.require_batch(ORDER_LINES.typed(with_times))
    with pytest.raises(RuleViolation, match="key_unique: 1"):
        ORDER_LINES.require_table(core)


def test_publish_switches_all_layers_at_once(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "store"))
    one = spark.createDataFrame([(1,)], "id int")
    two = spark.createDataFrame([(1,), (2,)], "id int")
    assert store.version == 0 and store.read("core", one.schema).count() == 0
    core, _ = store.write("core", one)
    staging, _ = store.write("staging", one)
    assert store.read("core", one.schema).count() == 0
    assert store.publish({"core": core, "staging": staging}) == 1
    newer, _ = store.write("core", two)
    assert store.read("core", one.schema).count() == 1
    assert store.publish({"core": newer}) == 2
    assert store.read("core", one.schema).count() == 2
    assert store.read("staging", one.schema).count() == 1


def test_of_two_writers_the_second_is_refused(spark, tmp_path):
    root = str(tmp_path / "store")
    one, two = Snapshots(spark, root), Snapshots(spark, root)
    df = spark.createDataFrame([(1,)], "id int")
    base = one.version
    mine, theirs = one.write("core", df)[0], two.write("core", df.union(df))[0]
    assert one.publish({"core": mine}, base) == 1
    with pytest.raises(PublishConflict):
        two.publish({"core": theirs}, base)
    assert two.version == 1 and two.read("core", df.schema).count() == 1


def test_a_writer_that_dies_blocks_nobody(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    df = spark.createDataFrame([(1,)], "id int")
    dying, other = Snapshots(spark, root), Snapshots(spark, root)
    folder = dying.write("core", df)[0]

    def die(pending, target):
        raise KeyboardInterrupt

    monkeypatch.setattr(dying, "_move", die)
    with pytest.raises(KeyboardInterrupt):
        dying.publish({"core": folder})
    (tmp_path / "store" / "commits" / "_left-behind.pending").write_text("{")
    assert other.version == 0 and other.publish({"core": folder}) == 1 and other.publish({}) == 2
    # A file in a commit's place that is none is not current; it can be taken away.
    (tmp_path / "store" / "commits" / "000000000003.json").write_text("")
    assert other.version == 2
    with pytest.raises(PublishConflict):
        other.publish({})
    assert other.abandon() == [3] and other.publish({}) == 3


@pytest.mark.parametrize("compacted", [False, True])
def test_a_slow_writer_is_refused_however_late_it_comes(spark, tmp_path, compacted):
    root = str(tmp_path / "store")
    df = spark.createDataFrame([(1,)], "id int")
    slow, quick = Snapshots(spark, root), Snapshots(spark, root)
    mine, theirs = slow.write("core", df)[0], quick.write("core", df.union(df))[0]
    stale = slow._latest()
    quick.publish({"core": theirs})
    quick.publish({})
    quick.publish({"core": theirs})
    if compacted:
        quick.compact()  # versions 1 and 2 are free again
    slow._latest = lambda: stale  # it looked before the others published
    with pytest.raises(PublishConflict):
        slow.publish({"core": mine}, 0)
    assert quick.version == 3 and quick.read("core", df.schema).count() == 2
    assert quick.publish({}) == 4
    names = [p.name for p in (tmp_path / "store" / "commits").iterdir() if not p.name.endswith(".crc")]
    assert not [n for n in names if "pending" in n] and ("000000000001.json" in names) != compacted


def test_storage_that_cannot_keep_writers_apart_is_refused(spark, tmp_path, monkeypatch):
    from ledgerloom.sources import snapshots

    monkeypatch.setattr(snapshots, "SAFE_RENAME", ("hdfs",))
    with pytest.raises(ValueError, match="file cannot keep two writers apart"):
        Snapshots(spark, str(tmp_path / "store"))


def test_compaction_keeps_what_is_current(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "store"))
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string")
    first = store.write_parts("core", df, F.col("p"))
    store.publish({**first, "staging": store.write("staging", df)[0]})
    newer = store.write_parts("core", df.filter("id = 1"), F.col("p"))
    store.publish({**newer, "staging": store.write("staging", df)[0]})
    before = sorted(tuple(r) for r in store.read("core", df.schema).collect())
    store.compact()
    assert sorted(tuple(r) for r in store.read("core", df.schema).collect()) == before
    assert len(list((tmp_path / "store" / "staging").iterdir())) == 1
    assert len([p for p in (tmp_path / "store" / "commits").iterdir() if p.suffix == ".json"]) == 1


def test_parts_have_few_files_however_many_tasks_write(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "store"))
    df = spark.range(0, 4800, 1, 16).select("id", (F.col("id") % 24).cast("string").alias("p"))
    for folder in store.write_parts("core", df, F.col("p")).values():
        assert len(list((tmp_path / "store" / folder).glob("part-*"))) <= 2


def test_a_run_can_be_closed_by_another_log_object(spark, tmp_path):
    path = str(tmp_path / "runs")
    run_id = RunLog(spark, path).start()
    RunLog(spark, path).succeed(run_id, 2, 1)
    log = RunLog(spark, path)
    (row,) = log.state().collect()
    assert (row["run_id"], row["status"], row["affected_rows"]) == (run_id, "SUCCESS", 1)
    assert row["started_at"] <= row["finished_at"]
    log.compact()
    assert [r["status"] for r in log.state().collect()] == ["SUCCESS"] and log.events().count() == 2
    assert len(list((tmp_path / "runs").glob("part-*"))) == 1
    with pytest.raises(ValueError, match="never started"):
        log.fail("nobody", "x")


def test_run_log_keeps_the_state_of_every_run(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "runs"))
    assert log.state().count() == 0
    good, bad, open_run = log.start(), log.start(), log.start()
    log.succeed(good, 4, 3)
    log.fail(bad, "broken batch")
    state = {r["run_id"]: r for r in log.state().collect()}
    assert set(state) == {good, bad, open_run}
    assert (state[good]["status"], state[good]["staged_rows"], state[good]["affected_rows"]) == (
        "SUCCESS",
        4,
        3,
    )
    assert state[good]["error_message"] is None and state[good]["finished_at"] is not None
    assert (state[bad]["status"], state[bad]["error_message"]) == ("FAILED", "broken batch")
    assert (state[open_run]["status"], state[open_run]["finished_at"]) == ("RUNNING", None)
    assert log.state().filter(~F.col("status").isin("RUNNING", "SUCCESS", "FAILED")).isEmpty()
    log.check()
    log._append("x", 1, None, None, "PAUSED", None, None, None)
    with pytest.raises(RuleViolation, match="status_known: 1"):
        log.check()


def test_a_folder_of_one_machine_is_refused_on_several(spark, monkeypatch):
    from ledgerloom.sources import scratch

    def get(self, name, default=None):
        return default if name == "spark.checkpoint.dir" else "file:/tmp/warehouse"

    monkeypatch.setattr(type(spark.conf), "get", get)
    assert scratch.shared_folder(spark) == "file:/tmp/warehouse/_scratch"
    monkeypatch.setattr(spark.sparkContext, "master", "yarn")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(spark)
