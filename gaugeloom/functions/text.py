"""Text functions of the point formats and of the collector replies."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters each part of a point line escapes.
_ESCAPED = {
    "tagkey": r'[," =]',
    "tagval": r'[," =]',
    "fieldkey": r'[," =]',
    "name": r"[, ]",
    "fieldval": r'["\\]',
}


def escape(col: Column, kind: str) -> Column:
    """Backslash-escape ``col`` for the part of a point line called ``kind``."""
    return F.regexp_replace(col, f"({_ESCAPED[kind]})", r"\\$1")


def unescape(col: Column, kind: str) -> Column:
    return F.regexp_replace(col, rf"\\({_ESCAPED[kind]})", "$1")


def snake_case(col: Column) -> Column:
    """``HTTPServer`` to ``http_server``: a break before a capital that starts or follows a lower-case run."""
    return F.lower(F.regexp_replace(col, r"(?s)(?<=.)(?=\p{Lu}\p{Ll})|(?<=\p{Ll})(?=\p{Lu})", "_"))


def split_list(col: Column) -> Column:
    """Split on commas and any white space, without empty parts."""
    return F.filter(F.split(col, r"[,\s\x{85}\p{Z}]+"), lambda part: part != "")


def mask_url(col: Column) -> Column:
    """Hide the user and password of every URL in a message; up to the last ``@`` of a word, as a password may hold one."""
    return F.regexp_replace(col, r"(?:http|https)://[^\s]+:[^\s]+@", "http(s)://XXX:XXX@")


def namespace(*words: Column | str) -> Column:
    parts = [F.lit(w) if isinstance(w, str) else w for w in words]
    return F.replace(F.concat_ws("_", *parts), F.lit(" "), F.lit("_"))


# The characters that count as white space.
WHITE_SPACE = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def trim_space(col: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(col, F.lit(WHITE_SPACE))


_ESCAPE_TOKEN = r"\\[abfnrtv\\\"]|\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\[0-3][0-7]{2}"


def unquote(col: Column) -> Column:
    """The text inside double quotes, back quotes or a one-character single quote; otherwise unchanged."""
    inner = F.substring(col, F.lit(2), F.length(col) - 2)
    token = rf"(?s){_ESCAPE_TOKEN}|[^\\]"

    def decode(tok: Column) -> Column:
        kind = F.substring(tok, 2, 1)
        # One-letter escapes and the characters they stand for.
        simple = F.create_map(*[F.lit(x) for pair in {
            "a": "\x07", "b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\x0b",
            "\\": "\\", '"': '"',
        }.items() for x in pair])
        code = F.when(kind.isin("x", "u"), F.conv(F.substring(tok, 3, 4), 16, 10)).otherwise(
            F.conv(F.substring(tok, 2, 3), 8, 10))
        utf16 = F.decode(F.unhex(F.lpad(F.conv(code, 10, 16), 4, "0")), "UTF-16BE")
        return F.when(F.length(tok) == 1, tok).otherwise(F.coalesce(F.try_element_at(simple, kind), utf16))

    decoded = F.array_join(
        F.transform(F.regexp_extract_all(inner, F.lit(f"({token})"), F.lit(1)), decode), "")
    # Possessive repeats run as a loop; a backtracking one would recurse once per character.
    quoted = col.rlike(rf'\A"(?:{_ESCAPE_TOKEN}|[^"\\\n])*+"\z')
    plain = col.rlike(r'\A"[^"\\\n]*"\z|\A`[^`]*`\z|\A\'[^\'\\\n]\'\z')
    return F.when(plain, inner).when(quoted, decoded).otherwise(col)


def dsn_server(col: Column) -> Column:
    """Address inside a ``user:password@tcp(address)/`` connection string, else the default server."""
    return F.coalesce(
        F.nullif(F.regexp_extract(col, r"\(([^)]*)\)/", 1), F.lit("")), F.lit("127.0.0.1:3306"))


def host_port(address: Column, default_port: str) -> tuple[Column, Column, Column]:
    """Host, port and validity of ``host:port``; a missing port gets the default, extra colons are invalid."""
    full = F.when(address.contains(":"), address).otherwise(F.concat(address, F.lit(f":{default_port}")))
    parts = F.split(full, ":")
    ok = F.size(parts) == 2
    return F.when(ok, F.get(parts, F.lit(0))), F.when(ok, F.get(parts, F.lit(1))), ok


def server_url(url: Column) -> tuple[Column, Column, Column]:
    """Host, port and socket path of a cache server URL; the scheme defaults to ``tcp://``."""
    full = F.when(url.startswith("tcp://") | url.startswith("unix://"), url).otherwise(
        F.concat(F.lit("tcp://"), url))
    unix = full.startswith("unix://")
    pattern = r"\Atcp://(?:[^/@]*@)?(\[[^\]]*\]|[^:/?#]*)(?::([0-9]*))?"
    host = F.regexp_replace(F.regexp_extract(full, pattern, 1), r"[\[\]]", "")
    port = F.regexp_extract(full, pattern, 2)
    socket = F.regexp_extract(full, r"\Aunix://[^/]*(/[^?#]*)", 1)
    return F.when(~unix, host), F.when(~unix, port), F.when(unix, socket)
