"""Small tables with the awkward rows every operator has to take."""


SF = "/root/testdata/sf0.001"


def with_extra(spark, rows, schema):
    """Columns whose names operators use inside."""
    df = spark.createDataFrame(rows, schema)
    for name in ("digest", "best", "kept", "score", "fp", "row", "n", "norm", "place", "_nv_score2"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


def docs(spark, rows):
    return with_extra(spark, rows, "doc_id long, text string")


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
