"""Comparison of a query with its statement."""


def rows_of(table) -> list[str]:
    names = sorted(table.column_names)
    return sorted(map(repr, zip(*[table.column(n).to_pylist() for n in names], strict=True)))


def same(query, sql, spark, duck, sf) -> None:
    got, want = query(spark, sf).toArrow(), duck.execute(sql).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    a, b = rows_of(got), rows_of(want)
    assert len(a) == len(b)
    assert a == b
