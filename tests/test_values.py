import pytest
from pyspark.sql import functions as F

from gaugeloom.functions import lookups, text, times, values
from helpers import value


def run(rows, expr, *inputs, ddl="x string"):
    return [r[0] for r in rows(ddl, *[(i,) for i in inputs]).select(expr(F.col("x")).alias("y")).collect()]


def parsed(rows, fn, *inputs):
    return [None if f is None else value(f) for f in run(rows, fn, *inputs)]


RAW = ("ON", "OFF", "on", "Yes", "No", "YES", "no", "42", "1.5", "abc", "")


def test_parse_value_first_version(rows):
    assert parsed(rows, lambda c: values.parse_value(c, 1), *RAW) == [
        1.0, 0.0, None, 1.0, 0.0, None, None, 42.0, 1.5, None, None]


def test_parse_value_second_version(rows):
    assert parsed(rows, lambda c: values.parse_value(c, 2), *RAW) == [1, 0, "on", 1, 0, 1, 0, 42, 1.5, "abc", None]


def test_strict_numbers(rows):
    texts = ("12", "+5", "-7", " 12 ", "1d", "9223372036854775808", "1.", ".5", "1e3", "1e400", "0x1", "Inf", "nan", "1_0")
    assert run(rows, values.strict_int, *texts) == [12, 5, -7] + [None] * 11
    floats = run(rows, values.strict_float, *texts)
    assert floats[:11] == [12.0, 5.0, -7.0, None, None, 9223372036854775808.0, 1.0, 0.5, 1000.0, None, None]
    assert floats[11] == float("inf") and floats[12] != floats[12] and floats[13] is None


@pytest.mark.parametrize("number, shown", [
    (15000000.0, "15000000"), (1.5, "1.5"), (-0.00012, "-0.00012"), (1e21, "1000000000000000000000"), (0.0, "0"),
    (123456789.25, "123456789.25"), (1e-7, "0.0000001"), (-2.5e10, "-25000000000"), (1.25e-5, "0.0000125"), (100.0, "100"),
])
def test_plain_number(rows, number, shown):
    assert run(rows, values.plain_number, number, ddl="x double") == [shown]


def test_unsigned_clamp_and_list_text(rows):
    from decimal import Decimal

    assert [value(f) for f in run(rows, values.unsigned_field, Decimal(2**64 - 1), Decimal(7), ddl="x decimal(20,0)")] == [2**63 - 1, 7]
    assert run(rows, values.list_text, [1, 2, 3], ddl="x array<int>") == ["[1 2 3]"]


@pytest.mark.parametrize("kind, raw, escaped", [
    ("tagkey", "a b=c", r"a\ b\=c"), ("tagval", 'x,"y"', r'x\,\"y\"'), ("name", "m,x y=z", r"m\,x\ y=z"),
    ("fieldval", 'say "hi" \\ bye', r'say \"hi\" \\ bye'),
])
def test_escape_round_trip(rows, kind, raw, escaped):
    assert run(rows, lambda c: text.escape(c, kind), raw) == [escaped]
    assert run(rows, lambda c: text.unescape(c, kind), escaped) == [raw]


def test_text_functions(rows):
    assert run(rows, text.snake_case, "HTTPServer", "fooBar", "FooBAR", "", "A") == ["http_server", "foo_bar", "foo_bar", "", "a"]
    assert run(rows, text.split_list, "a, b\tc,, d ", "") == [["a", "b", "c", "d"], []]
    assert run(rows, text.mask_url, "get https://u:p@h:1/x failed", "http://h/x") == [
        "get http(s)://XXX:XXX@h:1/x failed", "http://h/x"]
    assert run(rows, text.unquote, '"http-8080"', "http-8080", '"a\\"b\\n\\u0041\\x42"', "`raw`", '"bad', "'x'") == [
        "http-8080", "http-8080", 'a"b\nAB', "raw", '"bad', "x"]
    assert run(rows, text.dsn_server, "root:root@tcp(10.0.0.1:3307)/?tls=false", "junk") == ["10.0.0.1:3307", "127.0.0.1:3306"]
    assert run(rows, lambda c: text.namespace("info_schema", c), "table size") == ["info_schema_table_size"]


def test_addresses(rows):
    def pair(c):
        return F.struct(*text.host_port(c, "2181"))

    assert [tuple(r) for r in run(rows, pair, "h:1", "h", ":2181", "a:b:c")] == [
        ("h", "1", True), ("h", "2181", True), ("", "2181", True), (None, None, False)]
    urls = run(rows, lambda c: F.struct(*text.server_url(c)), "tcp://:pw@h:6379", "localhost:6379", "unix:///tmp/x.sock", "tcp://h")
    assert [tuple(r) for r in urls] == [("h", "6379", None), ("localhost", "6379", None), (None, None, "/tmp/x.sock"), ("h", "", None)]


THREADS = [("Query", "sending data", "sending data"), ("Query", "Sending_data", "sending data"), ("Query", "update", "updating"),
           ("Query", "Waiting for table metadata lock", "waiting for lock"), ("Sleep", "", "idle"), ("Query", "strange", "executing"),
           ("Binlog Dump", "strange", "replication master"), ("Connect", "strange", "other"), (None, None, "other")]


def test_thread_state(rows):
    df = rows("c string, s string, e string", *THREADS)
    assert all(r.e == r.y for r in df.withColumn("y", lookups.thread_state(F.col("c"), F.col("s"))).collect())


def test_status_names(rows):
    names = ("Com_select", "Aria__x", "Aria_x", "Binlog__y", "wsrep_z", "Slow_queries", "Uptime", "Open_files", "Executed_e_f")
    assert run(rows, lookups.status_name, *names) == [
        "commands_select", "aria_x", None, "binlog_y", "wsrep_z", "slow_queries", None, "open_files", "executed_e_f"]


def test_health_and_ceiling(rows):
    assert run(rows, lookups.health_code, "green", "YELLOW", "Red", "grey", None) == [1, 2, 3, 0, 0]
    df = rows("d string, t string", ("tinyint", "tinyint(4)"), ("int", "int(10) unsigned"), ("bigint", "bigint unsigned"), ("text", "text"))
    out = [r[0] for r in df.select(lookups.auto_increment_max(F.col("d"), F.col("t"))).collect()]
    assert out == [127, 2**32 - 1, 2**64 - 1, None]


def test_rounding(rows):
    ns = (1_499_999_999, 1_500_000_000, -1_500_000_000, 0)
    assert run(rows, lambda c: times.round_ns(c, 10**9), *ns, ddl="x bigint") == [10**9, 2 * 10**9, -10**9, 0]
    # seven seconds does not divide the distance to year 1
    step, base = 7 * 10**9, times.YEAR_ONE_SECONDS * 10**9
    for x in (0, 3 * 10**9, 1_700_000_000_123_456_789):
        over = (x + base) % step
        want = x - over if 2 * over < step else x + step - over
        assert run(rows, lambda c: times.round_ns(c, step), x, ddl="x bigint") == [want]
    assert [times.precision_for(0, n) for n in (10**10, 10**7, 10**4, 5)] == [10**9, 10**6, 10**3, 1]
    assert times.precision_for(42, 10**9) == 42


def test_wall_clock(rows):
    from helpers import T0

    df = rows("c timestamp, u double, t bigint", (T0, 100.0, 40_000_000_000_123))
    out = df.select(F.unix_micros(times.wall_clock(F.col("c"), F.col("u"), F.col("t"))) - F.unix_micros("c")).first()[0]
    assert out == -60_000_000 + 0


def test_trim_space(rows):
    assert run(rows, text.trim_space, " \t a b \r\n", "　x", "") == ["a b", "x", ""]
