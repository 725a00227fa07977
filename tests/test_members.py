"""Member import: points, validation, merge rules, safe replacement."""

import random

import pytest
from pyspark.sql import functions as F

from wireloom.operators.members import (
    first_per_member,
    loyalty_points,
    merge_members,
    normalised_old_rows,
    rejected_rows,
    to_member_rows,
)
from wireloom.plans.member_import import import_members, run_import
from wireloom.schema import MEMBER_CSV, MEMBER_TABLE
from wireloom.sources.members import read_member_csv, read_member_table, replace_member_table

NEW = MEMBER_CSV.fieldNames()

def now():
    return F.timestamp_millis(F.lit(1_600_000_000_000))



def new_rows(spark, rows):
    """Rows are (member id, points)."""
    data = [(f"c{i}", "n", key, f"p{i}", pts, "chg", i) for i, (key, pts) in enumerate(rows)]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MEMBER_CSV.fields)
    return spark.createDataFrame(data, schema + ", seq long")


def old_rows(spark, keys):
    data = [
        (f"id{i}" if key is None else key, f"o{i}", 5, 777, f"ID{i}", f"U{i}", i, key)
        for i, key in enumerate(keys)
    ]
    df = spark.createDataFrame(
        data,
        "id string, partner_code string, partner_point long, point long, idcard_no string,"
        " unionId string, convert_status long, partner_member_id string",
    )
    df = df.withColumns(
        {
            "generation_time": F.timestamp_millis(F.lit(0)),
            "partner_member_card": F.lit("oc"),
            "user_name": F.lit("o"),
            "mobile_phone": F.lit("op"),
            "partner_change": F.lit("old"),
            "seq": F.col("convert_status"),
        }
    )
    return normalised_old_rows(df, "seq")


def merge(spark, new, old):
    merged = merge_members(
        to_member_rows(new_rows(spark, new), "P", now()), old_rows(spark, old), now()
    )
    rows = merged.withColumn("generation_time", F.unix_seconds("generation_time")).collect()
    return {
        r.partner_member_id: (
            r.partner_code, r.partner_member_card, r.point, r.idcard_no, r.unionId,
            r.convert_status, r.generation_time,
        )
        for r in rows
    }


def test_points(spark):
    df = spark.createDataFrame([(9999,), (10000,), (None,), (-1,)], "p long")
    got = [r[0] for r in df.select(loyalty_points(F.col("p"))).collect()]
    assert got == [49995, 100000, 0, -5]


@pytest.mark.parametrize(
    "new, old, expected",
    [
        ([("a", 1)], [], ("P", "c0", 5, "", "", 0, 1_600_000_000)),
        ([], ["a"], ("o0", "oc", 777, "ID0", "U0", 0, 0)),
        ([("a", 10000)], ["a"], ("P", "c0", 100000, "ID0", "U0", 0, 1_600_000_000)),
        ([("a", 1), ("a", 2)], ["a"], ("P", "c0", 5, "", "", 0, 1_600_000_000)),
        ([("a", 1), ("a", 2)], [], ("P", "c0", 5, "", "", 0, 1_600_000_000)),
        ([], ["a", "a"], ("o0", "oc", 25, "ID1", "U1", 1, 1_600_000_000)),
        ([], ["a", "a", "a"], ("o0", "oc", 25, "ID1", "U1", 1, 1_600_000_000)),
    ],
)
def test_merge_rules(spark, new, old, expected):
    assert merge(spark, new, old) == {"a": expected}


def test_one_member_with_a_third_of_all_rows(spark):
    rng = random.Random(7)
    new = [("hot" if i % 3 == 0 else f"m{rng.randrange(300)}", i) for i in range(900)]
    old = ["hot" if i % 3 == 0 else f"m{rng.randrange(300)}" for i in range(600)]
    rows = {}
    for i, (key, pts) in enumerate(new):
        pay = pts * (10 if pts >= 10000 else 5)
        rows.setdefault(key, []).append(["P", f"c{i}", pay, "", "", 0, 1_600_000_000, pts])
    for i, key in enumerate(old):
        rows.setdefault(key, []).append([f"o{i}", "oc", 777, f"ID{i}", f"U{i}", i, 0, 5])
    expected = {}
    for key, group in rows.items():
        first = list(group[0])
        if len(group) > 1:
            first[2] = first[7] * 5
            first[3:6] = group[1][3:6]
            first[6] = 1_600_000_000
        expected[key] = tuple(first[:7])
    assert merge(spark, new, old) == expected


def test_groups_are_limited_before_the_shuffle(spark):
    merged = merge_members(
        to_member_rows(new_rows(spark, [("a", 1)]), "P", now()), old_rows(spark, ["a"]), now()
    )
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("WindowGroupLimit") == 2


def test_each_side_is_scanned_once(spark, tmp_path):
    for name, rows in (("new", to_member_rows(new_rows(spark, [("a", 1)]), "P", now())),
                       ("old", old_rows(spark, ["a", None]))):
        rows.write.parquet(str(tmp_path / name))
    new, old = (spark.read.parquet(str(tmp_path / name)) for name in ("new", "old"))
    plan = merge_members(new, old, now())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2


def test_old_rows_without_member_id_pass(spark):
    got = merge_members(
        to_member_rows(new_rows(spark, [("a", 1)]), "P", now()), old_rows(spark, [None, None]), now()
    ).collect()
    assert sorted(r.id for r in got) == ["a", "id0", "id1"]


def test_first_per_member(spark):
    rows = first_per_member(new_rows(spark, [("a", 1), ("a", 2), ("b", 3)])).collect()
    assert sorted((r.partner_member_id, r.partner_point) for r in rows) == [("a", 1), ("b", 3)]


def test_csv_order_and_rejects(spark, tmp_path):
    (tmp_path / "b.csv").write_text("c3,n,m1,p,5,x\n")
    (tmp_path / "a.csv").write_text("c1,n,m1,p,7,\nc2,n,,p,1,x\nc9,n,m2,p,abc,x\nc4,n,m4,p,,\n")
    rows = read_member_csv(spark, str(tmp_path))
    reasons = {r.partner_member_card: r.reason for r in rejected_rows(rows).collect()}
    assert reasons == {"c2": "no member id", "c9": "does not fit the schema"}
    members = to_member_rows(rows, "P", now()).orderBy("seq").collect()
    assert [r.partner_member_card for r in members] == ["c1", "c4", "c3"]
    assert [(r.partner_point, r.point, r.partner_change) for r in members] == [
        (7, 35, ""), (0, 0, ""), (5, 25, "x"),
    ]


def test_long_file_keeps_its_order(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text("".join(f"c{i},n,m{i},p,{i},x\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = read_member_csv(spark, str(path))
        assert rows.rdd.getNumPartitions() > 4
        points = [r[0] for r in rows.orderBy("seq").select("partner_point").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert points == list(range(20000))


@pytest.mark.parametrize("dedupe, kept", [(False, ""), (True, "ID0")])
def test_import_replaces_a_table_it_reads(spark, tmp_path, dedupe, kept):
    table = str(tmp_path / "members")
    old_rows(spark, ["a", "b"]).drop("seq").write.parquet(table)
    (tmp_path / "in.csv").write_text("c0,n,a,p,1,x\nc1,n,a,p,2,x\nc2,n,,p,2,x\nc3,n,c,p,3,x\n")
    old = spark.read.schema(MEMBER_TABLE).parquet(table).withColumn("seq", F.col("id"))
    summary = run_import(
        read_member_csv(spark, str(tmp_path / "in.csv")),
        old,
        "P",
        lambda rows: rows.write.mode("overwrite").parquet(table),
        now(),
        dedupe_new=dedupe,
    )
    assert (summary.rows_read, summary.rows_rejected) == (4, 1)
    assert (summary.old_rows, summary.rows_written, summary.rows_merged) == (2, 3, 1)
    got = {r.id: r for r in spark.read.parquet(table).collect()}
    assert sorted(got) == ["a", "b", "c"]
    assert got["a"].idcard_no == kept
    assert spark.read.parquet(summary.rejects).count() == 1


def test_missing_parameters(spark):
    with pytest.raises(ValueError, match="partner_code"):
        import_members(spark, "x.csv", "t", " ", "jdbc:x")
    with pytest.raises(ValueError, match="csv"):
        import_members(spark, "", "t", "P", "jdbc:x")


class _Recorder:
    """Stands in for a reader or writer and records what it is told."""

    def __init__(self, result=None):
        self.calls, self.result = [], result

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self.result if name == "jdbc" else self

        return call


class _Session:
    def __init__(self, reader):
        self.read = reader


def test_jdbc_read_options(spark):
    rows = spark.range(3)
    reader = _Recorder(rows)
    read_member_table(_Session(reader), "u", "t", {"user": "x"}, column="k", bounds=(0, 9))
    size = {"fetchsize": "10000"}
    assert reader.calls == [
        (
            "jdbc",
            ("u", "t"),
            dict(column="k", lowerBound=0, upperBound=9, numPartitions=20,
                 properties={"user": "x", **size}),
        )
    ]
    reader = _Recorder(rows)
    read_member_table(_Session(reader), "u", "t", predicates=["a < 1", "a >= 1"], fetch_size=5)
    assert reader.calls == [
        ("jdbc", ("u", "t"), dict(predicates=["a < 1", "a >= 1"], properties={"fetchsize": "5"}))
    ]
    with pytest.raises(ValueError, match="split"):
        read_member_table(_Session(_Recorder(rows)), "u", "t")


@pytest.mark.parametrize("column", ["point", "partner_point", "convert_status", "generation_time"])
def test_unreadable_old_rows_stop_the_import(spark, tmp_path, column):
    (tmp_path / "in.csv").write_text("c0,n,a,p,1,x\n")
    old = old_rows(spark, ["a", "b", "c"]).drop("unreadable")
    odd = F.when(F.col("id") == "b", F.lit("many")).otherwise(F.col(column).cast("string"))
    with pytest.raises(ValueError, match="1 old rows have values .* unchanged") as error:
        run_import(
            read_member_csv(spark, str(tmp_path / "in.csv")),
            old.withColumn(column, odd),
            "P",
            lambda rows: pytest.fail("table was replaced"),
            now(),
        )
    (row,) = spark.read.parquet(str(error.value).rsplit(" ", 1)[1]).collect()
    assert (row.id, row.unreadable) == ("b", column)


def test_null_old_values_still_get_defaults(spark, tmp_path):
    old = old_rows(spark, ["a"]).withColumn("point", F.lit(None).cast("string"))
    (row,) = normalised_old_rows(old, "seq").collect()
    assert row.point == 0 and row.unreadable == ""


def test_jdbc_write_options():
    class Rows:
        def __init__(self):
            self.write = _Recorder()

        def repartition(self, n):
            self.slices = n
            return self

    rows = Rows()
    replace_member_table(rows, "u", "t", {"user": "x"}, partitions=7)
    assert rows.slices == 7
    assert rows.write.calls == [
        ("mode", ("overwrite",), {}),
        ("option", ("truncate", "true"), {}),
        ("option", ("batchsize", 5000), {}),
        ("jdbc", ("u", "t"), {"properties": {"user": "x"}}),
    ]


@pytest.mark.parametrize(
    "text, old, counts",
    [
        ("c0,n,a,p,1,x\n", [], (1, 0, 0, 1, 0)),
        ("c0,n,,p,1,x\n", ["a"], (1, 1, 1, 1, 0)),
        ("", ["a", "a"], (0, 0, 2, 1, 1)),
        ("", [], (0, 0, 0, 0, 0)),
    ],
)
def test_import_of_nothing(spark, tmp_path, text, old, counts):
    (tmp_path / "in.csv").write_text(text)
    written = []
    summary = run_import(
        read_member_csv(spark, str(tmp_path / "in.csv")),
        old_rows(spark, old) if old else old_rows(spark, ["a"]).limit(0),
        "P",
        lambda rows: written.append(rows.count()),
        now(),
    )
    assert counts == (
        summary.rows_read, summary.rows_rejected, summary.old_rows, summary.rows_written,
        summary.rows_merged,
    )
    assert written == [summary.rows_written]


def test_old_rows_without_required_columns_stop_the_import(spark, tmp_path):
    (tmp_path / "in.csv").write_text("c0,n,a,p,1,x\n")
    old = old_rows(spark, ["b"]).withColumn("id", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="unchanged"):
        run_import(
            read_member_csv(spark, str(tmp_path / "in.csv")),
            old,
            "P",
            lambda rows: pytest.fail("table was replaced"),
            now(),
        )
