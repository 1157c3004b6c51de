"""Rows of Spark and DuckDB in one comparable form."""


def plain(row):
    def one(x):
        if hasattr(x, "tzinfo"):
            return x.replace(tzinfo=None)
        return float(x) if type(x).__name__ in ("Decimal", "float") else x

    return tuple(one(x) for x in row)


def same_rows(df, con, sql):
    cols = sorted(df.columns)
    relation = con.sql(sql)
    assert sorted(relation.columns) == cols
    key = lambda r: tuple(map(str, r))
    mine = sorted((plain(r) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=key)
    names = ", ".join('"' + c + '"' for c in cols)
    theirs = sorted((plain(r) for r in con.sql(f"SELECT {names} FROM ({sql}) AS z").fetchall()), key=key)
    assert mine == theirs
