"""Coordination service reports over landed ``mntr`` replies. Each reply is handled inside its row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gaugeloom.functions.maps import last_value, last_wins, lines, once
from gaugeloom.functions.text import host_port
from gaugeloom.functions.values import int_else_string
from gaugeloom.model import Result, error_rows
from gaugeloom.operators.points import map_point

SOURCE = "zookeeper"

# The form of a reply line and the default port.
LINE = r"\Azk_(\w+)\s+([\w\.\-]+)"
DEFAULT_PORT = "2181"


def mntr(snapshots: DataFrame) -> Result:
    """One point per reply. A line of another form, or a bad address, refuses the whole reply."""
    host, port, address_ok = host_port(F.col("server"), DEFAULT_PORT)
    rows = once(snapshots, _lines=F.when(F.col("payload") == "", F.array().cast("array<string>")).otherwise(
        lines(F.col("payload"))))
    rows = once(rows, _bad=F.try_element_at(F.filter("_lines", lambda x: ~x.rlike(LINE)), F.lit(1)))
    failed = (F.when(~address_ok, F.concat(F.lit("Invalid service address: "), F.col("server")))
              .when(F.col("_bad").isNotNull(), F.concat(F.lit("unexpected line in mntr response: "), F.col("_bad"))))
    pairs = F.transform("_lines", lambda x: F.struct(
        F.regexp_replace(F.regexp_extract(x, LINE, 1), r"\Azk_", "").alias("k"), F.regexp_extract(x, LINE, 2).alias("v")))
    good = once(rows.filter(failed.isNull()), _pairs=pairs)
    numbers = F.transform(F.filter("_pairs", lambda p: p["k"] != "server_state"),
                          lambda p: F.struct(p["k"].alias("k"), int_else_string(p["v"]).alias("v")))
    tags = F.create_map(F.lit("server"), host, F.lit("port"), port,
                        F.lit("state"), last_value(F.col("_pairs"), "server_state"))
    errors = error_rows(rows.filter(failed.isNotNull()), SOURCE, failed, server=F.col("server"),
                        endpoint=F.col("endpoint"), ts=F.col("collected_at"))
    return Result(map_point(good, "zookeeper", tags, last_wins(numbers), F.col("collected_at"), source=SOURCE), errors)
