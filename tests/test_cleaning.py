import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import sales_cleaning
from ledgerloom.sources.csv import read_csv
from tests import fixed_values as fv


def test_fixed_lines_clean_to_the_fixed_result(table, rows):
    clean = sales_cleaning.clean_sales(table(fv.DIRTY_SALES), iso_day_first=True)
    expected = table(fv.CLEAN_SALES)
    typed = expected.select(*[F.col(c).cast(clean.schema[c].dataType).alias(c) for c in clean.columns])
    assert clean.count() == 19
    assert rows(clean) == rows(typed)


def test_year_first_dates_stay_in_august_by_default(table):
    clean = sales_cleaning.clean_sales(table(fv.DIRTY_SALES))
    low, high = clean.agg(F.min("order_date").cast("string"), F.max("order_date").cast("string")).first()
    assert (clean.count(), low, high) == (19, "2026-08-01", "2026-08-12")


def test_report_adds_up_to_the_raw_lines(table):
    raw = table(fv.DIRTY_SALES)
    report = {r[0]: r[1] for r in sales_cleaning.cleaning_report(raw).collect()}
    assert report == {
        "exact_duplicate": 1,
        "missing_country": 1,
        "invalid_number": 3,
        "non_positive_quantity": 2,
        "invalid_date": 1,
        "kept": 19,
    }
    assert sum(report.values()) == raw.count() == 27


def test_summary(table, rows):
    clean = sales_cleaning.clean_sales(table(fv.DIRTY_SALES))
    summary = sales_cleaning.sales_summary(clean)
    expected = table(fv.SALES_SUMMARY)
    typed = expected.select(*[F.col(c).cast(summary.schema[c].dataType).alias(c) for c in summary.columns])
    assert [tuple(r) for r in summary.collect()] == [tuple(r) for r in typed.collect()]


def test_odd_lines(table, rows):
    raw = table(
        "order_id,customer_id,order_date,product,category,quantity,unit_price,country\n"
        "1,,2026-08-01,\tA ,x,1.9,10,united STATES\n"
        "2,C,2026-08-01,A,,0.5,10,  \n"
        "3,C,2026-08-01,A,x,1d,10,ES\n"
        "4,C,2026-08-01,A,x,nan,10,ES\n"
        "5,C,2026-08-01,A,x,1,inf,ES\n"
        "6,C,2026-08-01,A,x,1e1,0,ES\n"
        "7,C,2026-08-01,A,x,2,10,ES\n"
        "7,C,2026-08-01,A,x,2,10,ES \n"
    )
    clean = sales_cleaning.clean_sales(raw)
    assert rows(clean, "order_id", "product", "category", "quantity", "country") == [
        ("1", "A", "X", 1, "United states"),
        ("2", "A", None, 0, ""),
        ("7", "A", "X", 2, "Es"),
        ("7", "A", "X", 2, "Es"),
    ]
    # A line without a category is in no group; an order counts once.
    assert rows(sales_cleaning.sales_summary(clean)) == [
        ("Es", "X", 1, 4, 40.0),
        ("United states", "X", 1, 1, 10.0),
    ]
    with pytest.raises(ValueError, match="country"):
        sales_cleaning.clean_sales(raw.drop("country"))


def test_values_out_of_range_are_no_numbers_and_large_ones_are_kept(table, rows):
    raw = table(
        "order_id,customer_id,order_date,product,category,quantity,unit_price,country\n"
        "1,C,2026-08-01,A,x,1e30,10,ES\n"
        "2,C,2026-08-01,A,x,1,1e400,ES\n"
        "3,C,2026-08-01,A,x,4,1e308,ES\n"
        "4,C,2026-08-01,A,x,1,1e19,ES\n"
        "5,C,2026-08-01,A,x,3,2,ES\n"
        "6,C,2026-08-01,A,x,3,2,PT\n"
    )
    clean = sales_cleaning.clean_sales(raw)
    assert rows(clean, "order_id", "quantity", "total_amount") == [("4", 1, 1e19), ("5", 3, 6.0), ("6", 3, 6.0)]
    report = {r[0]: r[1] for r in sales_cleaning.cleaning_report(raw).collect()}
    assert report == {"invalid_number": 3, "kept": 3, "exact_duplicate": 0} and sum(report.values()) == raw.count()
    assert rows(sales_cleaning.sales_summary(clean)) == [("Es", "X", 2, 4, 1e19 + 6), ("Pt", "X", 1, 3, 6.0)]


def test_each_value_is_parsed_once(table):
    plan = sales_cleaning.clean_sales(table(fv.DIRTY_SALES))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and plan.count("(?<=\\d)t)") == 1


def test_job_from_file_to_files(spark, tmp_path):
    source = tmp_path / "raw.csv"
    source.write_text(fv.DIRTY_SALES, encoding="utf-8")
    clean, summary = str(tmp_path / "clean"), str(tmp_path / "summary")
    sales_cleaning.run(spark, str(source), clean, summary)
    assert read_csv(spark, clean).count() == 19
    assert read_csv(spark, summary).count() == 7


def test_tiny_amounts_and_copies_that_differ_in_blanks_or_nulls(table, rows):
    raw = table(
        "order_id,customer_id,order_date,product,category,quantity,unit_price,country\n"
        "1,,2026-08-01,p,x,1,0.0000004,es\n"
        "2,,2026-08-01,p,x,3,0.0000001,es\n"
        "2,,2026-08-01,p,x,3,0.0000001,es\n"
        "2,,2026-08-01,p,x,3, 0.0000001,es\n"
        "3,c,2026-08-01,,y,1,1,es\n"
        "3,,2026-08-01,c,y,1,1,es\n"
    )
    clean = sales_cleaning.clean_sales(raw)
    assert clean.count() == 5
    (x, y) = sorted(rows(sales_cleaning.sales_summary(clean)), key=lambda r: r[1])
    assert x[:4] == ("Es", "X", 2, 7) and abs(x[4] - 1e-6) < 1e-20 and y == ("Es", "Y", 1, 2, 2.0)


def test_rows_are_reduced_before_copies_are_sought(table):
    plan = sales_cleaning.clean_sales(table(fv.DIRTY_SALES))._jdf.queryExecution().executedPlan().toString()
    shuffle = next(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    assert "_mark_a" in shuffle and plan.index("Exchange hashpartitioning") < plan.rindex("Filter")


def test_only_lines_that_pass_the_other_rules_have_their_date_read(table):
    header = "order_id,customer_id,order_date,product,category,quantity,unit_price,country\n"
    raw = table(header + "1,c,2 May 2026,p,k,1,2,x\n2,c,2 May 2026,p,k,none,2,x\n3,c,2 May 2026,p,k,1,2,\n4,c,2 Mai 2026,p,k,1,2,x\n")
    dates = {r["order_id"]: r["_date"] for r in sales_cleaning.read_values(raw).collect()}
    assert [str(dates[i]) for i in "1234"] == ["2026-05-02", "None", "None", "None"]
    steps = {r[0]: r[1] for r in sales_cleaning.cleaning_report(raw).collect()}
    assert steps == {"kept": 1, "invalid_number": 1, "missing_country": 1, "invalid_date": 1, "exact_duplicate": 0}
