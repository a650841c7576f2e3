"""Plain-Python views of points."""

from datetime import datetime, timezone

T0 = datetime(2018, 6, 1, 12, 0, 0, tzinfo=timezone.utc)
SNAP = "source string, server string, endpoint string, collected_at timestamp, payload string"


def value(field):
    return {"i": field.i, "f": field.f, "s": field.s, "b": field.b}[field.kind]


def points(df):
    """Sorted (measurement, tags, fields) triples."""
    out = [(r.measurement, dict(r.tags), {k: value(v) for k, v in r.fields.items()}) for r in df.collect()]
    return sorted(out, key=lambda p: (p[0], sorted(p[1].items()), sorted((k, str(v)) for k, v in p[2].items())))


def only(df):
    (one,) = points(df)
    return one


def snap(spark, payload, server="s1", source="x", endpoint="e", ts=T0):
    texts = [payload] if isinstance(payload, str) else payload
    return spark.createDataFrame([(source, server, endpoint, ts, p) for p in texts], SNAP)
