"""Redaction of free text: one pass over its tokens, with a small state that says what the last ones announced.

A text is parted into words and what stands between them (blanks, commas, brackets and quotes). Each word is classified by
itself: a URL, a scheme that a token follows, a key with or without its value, a local path, or plain. A key without its value
and a scheme put the pass into a state in which the next word, or what stands in the next pair of quotes, is withheld.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of which a name must hold one to be a secret's name; underscores, hyphens and case don't count.
SECRET_NAMES = ("password", "passwd", "passphrase", "secret", "token", "apikey", "accesskey", "privatekey", "credential", "authorization", "cookie")
SCHEMES = ("bearer", "basic")
CREDENTIAL, PATH = "[credential]", "[path]"
BETWEEN = " \t\r\n\f\x0b,;()[]{}<>\"'"
ENDS = ",;)]}>"


def any_of(tests) -> Column:
    return reduce(lambda a, b: a | b, tests)


def names_secret(text: Column, names: tuple[str, ...]) -> Column:
    return F.translate(F.lower(text), "_-.", "").rlike("|".join(names))


def local_path(word: Column) -> Column:
    """A POSIX path from the root or a home folder, a drive's or a share's path, or a file URL."""
    first, second, third = (F.substring(word, k, 1) for k in (1, 2, 3))
    drive = (F.lower(first) >= "a") & (F.lower(first) <= "z") & (second == ":") & third.isin("/", "\\")
    rooted = (first == "/") & (F.translate(word, "/", "") != "")
    return rooted | F.startswith(word, F.lit("~/")) | drive | F.contains(word, F.lit("\\")) | F.startswith(F.lower(word), F.lit("file:/"))


def public_url(word: Column, names: tuple[str, ...]) -> Column:
    """A URL as it may be shown: without its user, its password, and a query that names a secret; all of it goes if it can't be parsed."""
    user, query = F.try_parse_url(word, F.lit("USERINFO")), F.try_parse_url(word, F.lit("QUERY"))
    broken = F.try_parse_url(word, F.lit("HOST")).isNull() & F.contains(word, F.lit("@"))
    return F.when(user.isNotNull() | broken, CREDENTIAL).when(names_secret(query, names), F.concat(F.substring_index(word, "?", 1), F.lit("?" + CREDENTIAL))).otherwise(word)


def classified(piece: Column, names: tuple[str, ...]) -> Column:
    """(kind, text): what a piece is by itself, and what it shows where nothing announced it.

    Kinds are between, scheme, name (a secret's), opened (a secret's name with = or : at its end), and plain.
    """
    low = F.lower(piece)
    mark = F.least(*(F.when(F.instr(piece, c) > 0, F.instr(piece, c)).otherwise(1 << 30) for c in "=:"))
    head, upto, tail = F.substring(piece, F.lit(1), mark - 1), F.substring(piece, F.lit(1), mark), F.substring(piece, mark + 1, F.length(piece))
    url = lambda w: F.startswith(F.lower(w), F.lit("http://")) | F.startswith(F.lower(w), F.lit("https://"))
    made = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.alias("text"))
    return (
        F.when(F.instr(F.lit(BETWEEN), F.substring(piece, 1, 1)) > 0, made("between", piece))
        .when(url(piece), made("plain", public_url(piece, names)))
        .when(low.isin(*SCHEMES), made("scheme", piece))
        .when(local_path(piece), made("plain", F.lit(PATH)))
        .when(mark == (1 << 30), F.when(names_secret(piece, names), made("name", piece)).otherwise(made("plain", piece)))
        .when(names_secret(head, names), F.when((tail == "") | F.lower(tail).isin(*SCHEMES), made("opened", piece)).otherwise(made("plain", F.concat(upto, F.lit(CREDENTIAL)))))
        .when(local_path(tail), made("plain", F.concat(upto, F.lit(PATH))))
        .when(url(tail), made("plain", F.concat(upto, public_url(tail, names))))
        .otherwise(made("plain", piece))
    )


def redacted(text: Column | str, most: int = 240, names: tuple[str, ...] = SECRET_NAMES) -> Column:
    """Text without credentials and local paths, trimmed and at most ``most`` characters; public URLs stay.

    Withheld are values of keys that hold one of ``names`` (``key=value``, ``key: value``, quoted or not), what follows a bearer or basic
    scheme, users and passwords of URLs, and local paths. A null text stays null. The pass stops
    where ``most`` characters are made; a text without a slash, a scheme and a secret's name goes past it.
    """
    whole = F.trim(F.col(text) if isinstance(text, str) else text)
    pieces = F.regexp_extract_all(whole, F.lit(r"([\s,;()\[\]{}<>\"']+|[^\s,;()\[\]{}<>\"']+)"), F.lit(1))
    # The mode says what the next piece is: name (a secret's name was said), value, q" or q' (in the quotes of a value), Q" or Q' (its mark is made).
    state = lambda out, mode: F.struct(out.alias("out"), mode.alias("mode"))

    def between(s: Column, p: Column) -> Column:
        """Quotes open and close a value; a comma or a closing bracket ends what a name announced."""
        mode, held = s["mode"], F.substring(s["mode"], 2, 1)
        closes = F.contains(p, held)
        rest = F.substring(p, F.call_function("locate", held, p), F.length(p))
        quote = F.when(F.contains(p, F.lit('"')), 'q"').when(F.contains(p, F.lit("'")), "q'")
        ended = F.translate(p, ENDS, "") != p
        return (
            F.when(mode == "", state(F.concat(s["out"], p), mode))
            .when(F.startswith(mode, F.lit("Q")), F.when(closes, state(F.concat(s["out"], rest), F.lit(""))).otherwise(s))
            .otherwise(state(F.concat(s["out"], p), F.when((mode == "value") & quote.isNotNull(), quote).when(ended | F.startswith(mode, F.lit("q")), "").otherwise(mode)))
        )

    def word(s: Column, kind: Column, w: Column, raw: Column) -> Column:
        mode = s["mode"]
        say = lambda words, then: state(F.concat(s["out"], words), then)
        mark = raw.isin("=", ":")
        plain = say(w, F.when(kind == "name", "name").when(kind.isin("opened", "scheme"), "value").otherwise(""))
        return (
            F.when(mode == "", plain)
            .when(F.startswith(mode, F.lit("Q")), s)
            .when(F.startswith(mode, F.lit("q")), say(F.lit(CREDENTIAL), F.concat(F.lit("Q"), F.substring(mode, 2, 1))))
            .when((mode == "value") & ((kind == "scheme") | mark), say(raw, F.lit("value")))
            .when(mode == "value", say(F.lit(CREDENTIAL), F.lit("")))
            .when(mark, say(raw, F.lit("value")))
            .when(F.substring(raw, 1, 1).isin("=", ":"), say(F.concat(F.substring(raw, 1, 1), F.lit(CREDENTIAL)), F.lit("")))
            .otherwise(plain)
        )

    def step(s: Column, p: Column) -> Column:
        return F.when(F.length(s["out"]) >= most, s).when(p["c"]["kind"] == "between", between(s, p["p"])).otherwise(word(s, p["c"]["kind"], p["c"]["text"], p["p"]))

    parts = F.transform(pieces, lambda p: F.struct(p.alias("p"), classified(p, names).alias("c")))
    clean = F.aggregate(parts, state(F.lit(""), F.lit("")), step, lambda s: F.substring(s["out"], 1, most))
    needed = whole.rlike(r"[/\\]") | names_secret(whole, (*names, *SCHEMES))
    return F.when(needed, clean).otherwise(F.substring(whole, 1, most))
