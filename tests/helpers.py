import datetime as dt

from stratum.sources.schemas import parsed_schema

LOAD_TS = dt.datetime(2024, 6, 1)
SF_SMOKE = "/root/testdata/sf0.001"


def bronze(spark, source, rows):
    """Parsed-bronze rows from dicts; unspecified payload fields are NULL."""
    schema = parsed_schema(source)
    data = []
    for i, r in enumerate(rows):
        base = {"market": "USA", "source_file": f"{source.upper()}/USA/a.tsv", "file_row_number": i + 1,
                "load_timestamp": LOAD_TS}
        base.update(r)
        data.append(tuple(base.get(f.name) for f in schema.fields))
    return spark.createDataFrame(data, schema)
