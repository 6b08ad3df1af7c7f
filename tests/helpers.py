"""Small telemetry tables, and comparison with DuckDB."""

import datetime as dt

SCHEMA = "row_id long, generator_id string, site_name string, timestamp timestamp, fuel_level_l double, current double, battery_voltage double, status string"
START = dt.datetime(2026, 1, 1)


def telemetry(spark, rows):
    """rows: (generator, seconds, fuel, current, battery, status)."""
    data = [(k, g, "S", START + dt.timedelta(seconds=t), *map(lambda x: None if x is None else float(x), (f, c, b)), s) for k, (g, t, f, c, b, s) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def column(df, name, order="row_id"):
    return [r[name] for r in df.orderBy(order).select(name).collect()]


def normal(rows):
    cell = lambda v: None if v is None or v != v else f"{v:.6f}" if isinstance(v, float) else str(v)
    return sorted([tuple(cell(v) for v in r) for r in rows], key=str)


def same_as_duckdb(spark, sf_dir, query, sql):
    import duckdb

    con = duckdb.connect()
    for t in ("events", "documents", "conversations", "labels", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    ours = normal([tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()])
    theirs = con.sql(f"SELECT {', '.join(names)} FROM ({sql})").fetchall()
    assert ours == normal(theirs)
