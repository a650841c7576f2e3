"""Cache server reports over landed INFO replies. A reply is handled inside its own row: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeloom.functions.lookups import literal_map
from gaugeloom.functions.maps import last_wins, let, once
from gaugeloom.functions.text import server_url, trim_space
from gaugeloom.functions.values import float_field, int_field, int_float_string, strict_int
from gaugeloom.model import Result, no_errors
from gaugeloom.operators.points import map_point

SOURCE = "redis"

# Renamed keys, the keys kept from the server section, and keys never reported.
RENAMED = {"uptime_in_seconds": "uptime", "connected_clients": "clients", "role": "replication_role"}
SERVER_KEYS = ("lru_clock", "uptime_in_seconds", "redis_version")
DROPPED = "mem_allocator"


def sectioned(payload: Column) -> Column:
    """``struct<section,k,v>`` for every ``key:value`` line, under the last header above it."""
    # A block is a header line and the lines up to the next header. Lines before the first header belong to no
    # section: a nameless header is put in front of them.
    blocks = F.split(F.concat(F.lit("\n"), F.regexp_replace(payload, r"\A#", "\n#")), r"\n#")

    def name(block: Column) -> Column:
        head = F.rtrim(F.substring_index(block, "\n", 1), F.lit("\r"))
        return F.when(F.length(head) > 1, F.substring(head, F.lit(2), F.length(head))).otherwise(F.lit(""))

    def rows(block: Column, section: Column) -> Column:
        pairs = F.filter(F.split(block, r"\r?\n"), lambda line, i: (i > 0) & line.contains(":"))
        return F.transform(pairs, lambda line: F.struct(
            section.alias("section"), F.substring_index(line, ":", 1).alias("k"),
            trim_space(F.substring(line, F.instr(line, ":") + 1, F.length(line))).alias("v")))

    def under(names: Column) -> Column:
        # A header without a name keeps the section before it.
        def section(at: Column) -> Column:
            named = F.filter(F.slice(names, 1, at + 1), lambda n: n != "")
            own = F.element_at(names, at + 1)
            return F.when(own != "", own).otherwise(F.coalesce(F.try_element_at(named, F.lit(-1)), F.lit("")))

        return F.flatten(F.transform(blocks, lambda block, at: let(section(at), lambda s: rows(block, s))))

    return let(F.transform(blocks, name), under)


def _kept(row: Column) -> Column:
    return ((row["section"] != "Server") | row["k"].isin(*SERVER_KEYS)) & ~row["k"].startswith("master_replid") & (
        row["k"] != DROPPED) & ~row["k"].endswith("_human")


def _parsed(snapshots: DataFrame) -> DataFrame:
    host, port, socket = server_url(F.col("server"))
    rows = once(snapshots, _rows=F.filter(sectioned(F.col("payload")), _kept))
    space = F.filter("_rows", lambda r: (r["section"] == "Keyspace") & ~r["k"].isin(*RENAMED))
    plain = F.filter("_rows", lambda r: (r["section"] != "Keyspace") | r["k"].isin(*RENAMED))
    staged = once(rows, _space=space, _plain=plain)
    role = F.filter("_plain", lambda r: (r["k"] == "role") & strict_int(r["v"]).isNull())
    return staged.withColumn("_tags", F.create_map(
        F.lit("server"), host, F.lit("port"), port, F.lit("socket"), socket,
        F.lit("replication_role"), F.try_element_at(role, F.lit(-1))["v"]))


def _info_fields() -> Column:
    known = literal_map(RENAMED)

    def entry(r: Column) -> Column:
        value = int_float_string(r["v"])
        is_role = (r["k"] == "role") & (value["kind"] == "s")
        return F.struct(F.coalesce(F.try_element_at(known, r["k"]), r["k"]).alias("k"),
                        F.when(~is_role, value).alias("v"))

    def number(key: str) -> Column:
        whole = F.filter("_plain", lambda r: (r["k"] == key) & strict_int(r["v"]).isNotNull())
        return F.try_element_at(whole, F.lit(-1))["v"].try_cast("bigint")

    hits, misses = (F.coalesce(number(k), F.lit(0)) for k in ("keyspace_hits", "keyspace_misses"))
    rate = F.when((hits == 0) & (misses == 0), F.lit(0.0)).otherwise(F.try_divide(hits, F.try_add(hits, misses)))
    elapsed = F.try_subtract(F.unix_seconds("collected_at"), number("rdb_last_save_time"))
    derived = F.array(
        F.struct(F.lit("rdb_last_save_time_elapsed").alias("k"), int_field(elapsed).alias("v")),
        F.struct(F.lit("keyspace_hitrate").alias("k"), float_field(rate).alias("v")))
    return last_wins(F.concat(F.transform("_plain", entry), derived))


def _database_fields(line: Column) -> Column:
    return last_wins(F.transform(F.split(line, ","), lambda p: F.struct(
        F.split(p, "=")[0].alias("k"), int_field(strict_int(F.try_element_at(F.split(p, "="), F.lit(2)))).alias("v"))))


def _is_database(r: Column) -> Column:
    return r["v"].contains("keys=")


def _database_tags(r: Column) -> Column:
    return F.map_concat(F.col("_tags"), F.create_map(F.lit("database"), r["k"]))


def info(snapshots: DataFrame) -> Result:
    """One point per reply: typed keys, the hit rate, and the time since the last save."""
    rows = _parsed(snapshots)
    return Result(map_point(rows, "redis", F.col("_tags"), _info_fields(), F.col("collected_at"), source=SOURCE),
                  no_errors(snapshots.sparkSession))


def keyspace(snapshots: DataFrame) -> Result:
    """One point per database line ``db0:keys=2,expires=0,avg_ttl=0``; parts that are not whole numbers are left out."""
    rows = _parsed(snapshots).select("collected_at", "_tags", F.explode(F.filter("_space", _is_database)).alias("r"))
    points = map_point(rows, "redis_keyspace", _database_tags(F.col("r")), _database_fields(F.col("r.v")),
                       F.col("collected_at"), source=SOURCE)
    return Result(points, no_errors(snapshots.sparkSession))


def status(snapshots: DataFrame) -> Result:
    """Both kinds of points from one pass over the replies."""
    def point(name: str, tags: Column, fields: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), tags.alias("tags"), fields.alias("fields"))

    whole = F.array(point("redis", F.col("_tags"), _info_fields()))
    databases = F.transform(F.filter("_space", _is_database), lambda r: point(
        "redis_keyspace", _database_tags(r), _database_fields(r["v"])))
    rows = _parsed(snapshots).select("collected_at", F.explode(F.concat(whole, databases)).alias("p"))
    points = map_point(rows, F.col("p.name"), F.col("p.tags"), F.col("p.fields"), F.col("collected_at"), source=SOURCE)
    return Result(points, no_errors(snapshots.sparkSession))
