import math


def cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)) or str(x) in ("<NA>", "NaT"):
        return "null"
    return f"{x:.9g}" if isinstance(x, float) else str(x)


def rows(df):
    """Rows of a pandas frame, columns by name, in any order."""
    df = df[sorted(df.columns)]
    return sorted(tuple(map(cell, r)) for r in df.itertuples(index=False))


def same(spark_df, con, sql):
    a, b = spark_df.toPandas(), con.execute(sql).df()
    assert sorted(a.columns) == sorted(b.columns)
    assert rows(a) == rows(b)
