import pytest
from pyspark.sql import functions as F

from tintloom.operators import snapshot


def test_keep_first_and_positions(spark):
    rows = spark.createDataFrame([("a", 3, "x"), ("A", 1, "y"), ("b", 2, "z")], "k string, ord int, v string").selectExpr("lower(k) k", "ord", "v")
    firsts = snapshot.keep_first(rows, ["k"], ["ord"])
    assert {(r.k, r.v) for r in firsts.collect()} == {("a", "y"), ("b", "z")}
    numbered = snapshot.positions(spark.range(1000).selectExpr("1000 - id as n"), ["n"])
    assert all(r.n == r.position for r in numbered.collect())


def test_positions_of_more_rows_than_a_sample(spark):
    """Columns beside the order, an order of two columns and nulls in it; ranges are read for their sizes and for their rows."""
    rows = spark.range(60_000, numPartitions=6).selectExpr("(id * 7919) % 60000 as n", "repeat('x', 20) as text").withColumns({"a": F.when(F.col("n") >= 100, F.col("n").cast("int") % 3), "b": F.col("n")})
    found = snapshot.positions(rows, ["a", "b"]).collect()
    ordered = sorted(((-1 if r.a is None else r.a), r.b, r.position) for r in found)
    assert [p for *_, p in ordered] == [*range(1, 60_001)] and {r.text for r in found} == {"x" * 20}
    assert snapshot.positions(rows.where("n < 0"), ["b"]).count() == 0


def test_strict_join(spark):
    left = spark.createDataFrame([(" a ", 1, "l"), ("b", 2, "l")], "sku string, n int, side string")
    right = spark.createDataFrame([("a", "r"), (" b", "r")], "sku string, side string")
    found = {r.sku: (r.n, r.side) for r in snapshot.strict_join(left, right, "sku").collect()}
    assert found == {"a": (1, "r"), " b": (2, "r")}
    for bad in ([("a", "r")], [("a", "r"), ("b", "r"), ("c", "r")], [("a", "r"), ("b", "r"), ("b ", "r")], [("a", "r"), ("b", "r"), (" ", "r")]):
        with pytest.raises(snapshot.ContractError):
            snapshot.strict_join(left, spark.createDataFrame(bad, "sku string, side string"), "sku")


@pytest.mark.parametrize(
    ("links", "most", "expected"),
    [
        ([("u1", "u2", ["a"]), ("u2", "u3", ["b"]), ("u3", None, ["c"])], 100, ["u1", "u2", "u3"]),
        ([("u1", "u2", ["a"]), ("u2", "u1", ["b"])], 100, ["u1", "u2"]),
        ([("u1", "u2", ["a"]), ("u2", "u3", ["A"]), ("u3", None, ["c"])], 100, ["u1", "u2"]),
        ([("u1", "u2", ["a"]), ("u2", "u3", ["b"]), ("u3", None, ["c"])], 2, ["u1", "u2"]),
        ([("x", None, ["a"])], 2, []),
    ],
)
def test_pagination(spark, links, most, expected):
    pages = spark.createDataFrame(links, "url string, next string, product_ids array<string>")
    found = snapshot.pagination(pages, "u1", most).orderBy("page_no").collect()
    assert [r.url for r in found] == expected


def test_counts_never_go_below_zero(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "product_id string")
    variants = spark.createDataFrame([("f",), ("",), (None,)], "ingredient_set_id string")
    row = snapshot.run_counts(ids("a", "b"), ids("a", "x", "y"), variants, ids("f"), ids()).first()
    assert (row.inventory, row.completed, row.unresolved, row.variants_without_ingredients, row.status) == (2, 1, 1, 2, "partial")


def test_resume(spark):
    saved = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 2), ("b", 3)], "k string, v int")
    assert {tuple(r) for r in snapshot.resume_union(saved, new, ["k"]).collect()} == {("a", 1), ("b", 3)}
    assert snapshot.stale_keys(saved, new.where("k = 'b'"), ["k"]).count() == 1
    assert snapshot.missing_columns(saved, ["v", "w"]) == ["w"]
