"""Operator 6: personal data under format-preserving Feistel pseudonyms, in SQL functions only.

Found are payment card numbers (13 to 19 digits that pass the Luhn test), phone numbers
(ten digits in the usual grouping, with or without a country code 1), social security
numbers (valid area, group and serial), IPv4 addresses (four bytes), dates (that exist,
years 1800 to 2199) and e-mail addresses. What does not pass stays as it is.

Cards are looked for in whole runs of digit groups, at every group, so that numbers next to
a card (expiry, check value, amounts) do not hide it: spans in a usual card grouping come
first, then from left to right the longest. Dates are read day first, and month first where
only that exists.

Each value is permuted within its format by a keyed Feistel network: the value's two
halves take turns in adding a keyed hash of the other half, modulo the half's range.
  card    all digits but the last, which is computed anew, so the result passes Luhn;
  phone   its ten digits;  ssn  its nine digits;  ip  its two 16-bit halves;
  date    the day in the 400 years from 1800 (189 x 773 days), written in its own format;
          read month first, among the days after a 12th (9 x 9833), so it still reads so.
The map is one-to-one on a format, so equal values stay linked across documents, however
they are grouped, and different values stay different. Separators stay in place. An
e-mail address has no range to permute; it gets a keyed digest as its local part, at
example.com, equal for equal addresses (letter case aside).

A null text stays null. Matches are taken from left to right, none inside another. An
empty table gives an empty result; extra columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civic_indicators.llm.common import q

ROUNDS = 10
# The written forms that are looked for, most specific first.
EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}"
IP = r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)"
SSN = r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])"
_DATES = r"(?:\d{4}-\d{1,2}-\d{1,2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}-\d{1,2}-\d{4})"
DATE = rf"(?<![\w/.\-]){_DATES}(?![\w/\-]|\.\d)"
PHONE = r"(?<![\w+])(?:\+?1[ .\-]?)?(?:\(\d{3}\) ?|\d{3}[ .\-])\d{3}[ .\-]\d{4}(?![\w])"
OTHERS = "|".join((EMAIL, IP, DATE, SSN, PHONE))
# Digit groups of 13 digits or more in all, up to where another form starts; possessive, so that long runs need no stack.
_GROUP = r"\d++(?!\w|\.\d)"
RUN = rf"(?<![\w.])(?=\d(?:[ \-]?\d){{12}}){_GROUP}(?:[ \-](?!{OTHERS}){_GROUP})*+"
ANY = f"{OTHERS}|{RUN}"
USUAL = r"^(?:\d{13,19}|(?:\d{4} ){3}\d{4}|(?:\d{4}-){3}\d{4}|\d{4} \d{6} \d{4,5}|\d{4}-\d{6}-\d{4,5})$"


def _keyed(key: str, kind: str, i: Column, half: Column) -> Column:
    """A keyed hash, 0 to 2**60 - 1."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), half.cast("string")), 256), 1, 15), 16, 10).cast("bigint")


def feistel(left: Column, right: Column, left_range: Column, right_range: Column, key: str, kind: str) -> Column:
    """A struct (l, r): the pair permuted, one-to-one on the ranges."""
    def turn(s, i):
        to_left = F.pmod(s.l + F.pmod(_keyed(key, kind, i, s.r), left_range), left_range)
        to_right = F.pmod(s.r + F.pmod(_keyed(key, kind, i, s.l), right_range), right_range)
        even = i % 2 == 0
        return F.struct(F.when(even, to_left).otherwise(s.l).alias("l"), F.when(even, s.r).otherwise(to_right).alias("r"))

    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _ten_to(n: Column) -> Column:
    return F.pow(F.lit(10.0), n).cast("bigint")


def digits_permuted(d: Column, key: str, kind: str) -> Column:
    """A string of 2 to 36 digits, permuted among the strings of its length."""
    n = F.length(d)
    u = F.floor(n / 2).cast("int")
    out = feistel(F.substr(d, F.lit(1), u), F.substr(d, u + 1), _ten_to(u), _ten_to(n - u), key, f"{kind}")
    return F.concat(F.lpad(out.l.cast("string"), u, F.lit("0")), F.lpad(out.r.cast("string"), n - u, F.lit("0")))


def _only_digits(m: Column) -> Column:
    return F.regexp_replace(m, r"\D", "")


def luhn_sum(d: Column) -> Column:
    """The Luhn sum of a digit string whose last digit counts once."""
    n = F.length(d)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0).cast("bigint"), lambda s, i: s + _luhn(F.substr(d, i, F.lit(1)).cast("int"), (n - i) % 2 == 1))


def _luhn(x: Column, doubled: Column) -> Column:
    return F.when(doubled, x * 2 - F.when(x > 4, 9).otherwise(0)).otherwise(x).cast("bigint")


def _in_place(m: Column, digits: Column, skip: Column | int = 0) -> Column:
    """``m`` with its digits after the first ``skip`` replaced one by one."""
    start = F.struct(F.lit("").alias("s"), F.lit(1).alias("i"))

    def step(a, c):
        digit = c.rlike("^[0-9]$")
        new = F.when(digit & (a.i > skip), F.substr(digits, a.i - skip, F.lit(1))).otherwise(c)
        return F.struct(F.concat(a.s, new).alias("s"), F.when(digit, a.i + 1).otherwise(a.i).alias("i"))

    return F.aggregate(F.split(m, ""), start, step, lambda a: a.s)


def _card(m: Column, key: str) -> Column:
    d = _only_digits(m)
    body = digits_permuted(F.substr(d, F.lit(1), F.length(d) - 1), key, "card")
    check = F.pmod(F.lit(10) - luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10))
    return _in_place(m, F.concat(body, check.cast("string")))


def _ip(m: Column, key: str) -> Column:
    b = F.split(m, r"\.")
    half = F.lit(65536).cast("bigint")
    out = feistel(b[0].cast("bigint") * 256 + b[1].cast("bigint"), b[2].cast("bigint") * 256 + b[3].cast("bigint"), half, half, key, "ip")
    return F.concat_ws(".", *[x.cast("string") for v in (out.l, out.r) for x in (F.floor(v / 256), v % 256)])


def _read(m: Column) -> tuple[Column, Column]:
    """The date that is written, day first and month first, each or null."""
    p = F.split(m, r"[/.\-]")
    iso = F.length(F.get(p, F.lit(0))) == 4
    year, a, b = F.when(iso, F.get(p, F.lit(0))).otherwise(F.get(p, F.lit(2))), F.when(iso, F.get(p, F.lit(2))).otherwise(F.get(p, F.lit(0))), F.get(p, F.lit(1))

    def day(month: Column, day: Column) -> Column:
        text = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
        return F.when(m.rlike(f"^{_DATES}$"), F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date"))

    return day(b, a), F.when(~iso, day(a, b))


def _start() -> Column:
    return F.lit("1800-01-01").cast("date")


def _late_day(n: Column) -> Column:
    """The ``n``-th day after a 12th since 1800."""
    def before(k: Column) -> Column:
        return F.datediff(F.add_months(_start(), k), _start()) - k * 12

    def near(x: Column) -> Column:
        months = F.sequence(F.greatest(x.guess - 2, F.lit(0)), x.guess + 2)
        month = F.get(F.filter(months, lambda k: (before(k) <= x.n) & (x.n < before(k + 1))), F.lit(0))
        return _with(month, lambda k: F.date_add(F.add_months(_start(), k), (x.n - before(k) + 12).cast("int")))

    return _with(n, lambda i: _with(F.struct(i.alias("n"), F.floor(i * 4800 / 88497).cast("int").alias("guess")), near))


def _new_day(day: Column, key: str) -> Column:
    def permuted(n: Column) -> Column:
        return feistel(F.floor(n / 773), n % 773, F.lit(189).cast("bigint"), F.lit(773).cast("bigint"), key, "date")

    return _with(_with(F.datediff(day, _start()), permuted), lambda o: F.date_add(_start(), (o.l * 773 + o.r).cast("int")))


def _new_late_day(day: Column, key: str) -> Column:
    def permuted(n: Column) -> Column:
        return feistel(F.floor(n / 9833), n % 9833, F.lit(9).cast("bigint"), F.lit(9833).cast("bigint"), key, "month first")

    n = F.datediff(day, _start()) - ((F.year(day) - 1800) * 12 + F.month(day)) * 12
    return _with(_with(n, permuted), lambda o: _late_day(o.l * 9833 + o.r))


def _date(m: Column, key: str) -> Column:
    p, sep = F.split(m, r"[/.\-]"), F.regexp_extract(m, r"\d+([/.\-])", 1)

    def put(x: Column, i: int) -> Column:
        text = x.cast("string")
        return F.lpad(text, F.greatest(F.length(F.get(p, F.lit(i))), F.length(text)), F.lit("0"))

    def day_first(x: Column) -> Column:
        return F.when(F.length(F.get(p, F.lit(0))) == 4, F.concat_ws("-", F.year(x).cast("string"), put(F.month(x), 1), put(F.day(x), 2))).otherwise(
            F.concat(put(F.day(x), 0), sep, put(F.month(x), 1), sep, F.year(x).cast("string")))

    def month_first(x: Column) -> Column:
        return F.concat(put(F.month(x), 0), sep, put(F.day(x), 1), sep, F.year(x).cast("string"))

    a, b = _read(m)
    return _with(F.struct(a.alias("a"), b.alias("b")), lambda r: F.when(r.a.isNotNull(), _with(_new_day(r.a, key), day_first)).otherwise(
        _with(_new_late_day(r.b, key), month_first)))


def _bytes_ok(m: Column) -> Column:
    return F.forall(F.split(m, r"\."), lambda x: x.cast("int") <= 255)


def kind_of(m: Column) -> Column:
    """The kind of a match of ``OTHERS`` that passes its test, or null."""
    d = _only_digits(m)
    year = F.year(F.coalesce(*_read(m)))
    return (F.when(m.rlike(f"^{EMAIL}$"), "email")
            .when(m.rlike(r"^(?:\d{1,3}\.){3}\d{1,3}$"), F.when(_bytes_ok(m), "ip"))
            .when(m.rlike(f"^{_DATES}$"), F.when(year.between(1800, 2199), "date"))
            .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), F.when(~m.rlike(r"^(?:000|666|9..)") & ~m.rlike(r"-00-") & ~m.rlike(r"0000$"), "ssn"))
            .when(m.rlike(f"^(?:{PHONE})$") & (F.length(d) >= 10) & (F.length(d) <= 11), "phone"))


def _cards(m: Column) -> Column:
    """A run of digit groups in pieces (s, k): cards, and what stands between them."""
    part = F.regexp_extract_all(m, F.lit(r"\d+[ \-]?"), F.lit(0))

    def split_up(parts: Column) -> Column:
        n = F.size(parts)

        def text(i: Column, j: Column) -> Column:
            return F.array_join(F.slice(parts, i, j - i + 1), "")

        def span(i: Column, j: Column) -> Column:
            return F.struct(i.alias("i"), j.alias("j"), F.rtrim(text(i, j), F.lit(" -")).alias("s"))

        def passes(x: Column) -> Column:
            return _with(F.translate(x.s, " -", ""), lambda d: F.when(F.length(d).between(13, 19), luhn_sum(d) % 10 == 0).otherwise(False))

        # Longest first from each group; at most 19 groups make a card.
        spans = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.filter(
            F.transform(F.sequence(F.least(i + 18, n), i, F.lit(-1)), lambda j: span(i, j)), passes)))
        none = F.array().cast("array<struct<i:int,j:int,s:string>>")

        def sweep(of: Column) -> Column:
            start = F.struct(F.lit(0).alias("end"), none.alias("got"))
            return F.aggregate(of, start, lambda a, x: F.when(x.i > a.end, F.struct(x.j.alias("end"), F.concat(a.got, F.array(x)).alias("got"))).otherwise(a), lambda a: a.got)

        def choose(all_: Column) -> Column:
            return _with(sweep(F.filter(all_, lambda x: x.s.rlike(USUAL))), lambda first: F.array_sort(F.concat(
                first, sweep(F.filter(all_, lambda x: ~F.exists(first, lambda y: (x.i <= y.j) & (y.i <= x.j)))))))

        def piece(s: Column, kind: Column) -> Column:
            return F.struct(s.alias("s"), kind.cast("string").alias("k"))

        start = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<s:string,k:string>>").alias("out"))
        no = F.lit(None)
        return F.aggregate(
            _with(spans, choose), start,
            lambda a, x: F.struct((x.j + 1).alias("at"), F.concat(a.out, F.array(
                piece(text(a.at, x.i - 1), no), piece(x.s, F.lit("card")), piece(F.regexp_extract(F.get(parts, x.j - 1), r"[ \-]$", 0), no))).alias("out")),
            lambda a: F.concat(a.out, F.array(piece(text(a.at, n), no))))

    return _with(part, split_up)


def _with(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def pieces_of(m: Column) -> Column:
    """A match of ``ANY`` in pieces (s, k), k null for what stays."""
    run = m.rlike(r"^\d+(?:[ \-]\d+)*+$") & (F.length(_only_digits(m)) >= 13)
    return F.when(run, _cards(m)).otherwise(F.array(F.struct(m.alias("s"), kind_of(m).alias("k"))))


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    d = _only_digits(m)
    tail = F.substr(d, F.length(d) - 9)
    return (F.when(kind == "email", F.concat(F.lit("p"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m)), 256), 1, 16), F.lit("@example.com")))
            .when(kind == "ip", _ip(m, key)).when(kind == "date", _date(m, key))
            .when(kind == "ssn", _in_place(m, digits_permuted(d, key, "ssn")))
            .when(kind == "phone", _in_place(m, digits_permuted(tail, key, "phone"), F.length(d) - 10))
            .when(kind == "card", _card(m, key)).otherwise(m))


def pseudonymise(docs: DataFrame, key: str = "change-this-key", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, text (pseudonymised), n_found, kinds (array, in text order) for every row of ``docs``.

    Texts without a digit or an ``@`` pass untouched; the key is a parameter to be kept secret.
    """
    own = docs.select(q(doc_id).cast("bigint").alias("doc_id"), q(text).alias("t"))
    found = own.withColumn("m", F.when(F.col("t").rlike("[0-9@]"), F.regexp_extract_all("t", F.lit(ANY), 0)))
    found = found.withColumn("k", F.transform("m", pieces_of))
    new = F.transform("k", lambda ps: F.array_join(F.transform(ps, lambda x: pseudonym(x.s, x.k, key)), ""))
    # The text between the matches, each piece followed by the match's replacement.
    pieces = F.zip_with(F.split("t", ANY, -1), new, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    some = F.coalesce(F.size("m") > 0, F.lit(False))
    kinds = F.filter(F.transform(F.flatten("k"), lambda x: x.k), lambda k: k.isNotNull())
    return found.select("doc_id", F.when(some, F.array_join(pieces, "")).otherwise(F.col("t")).alias("text"),
                        F.when(some, F.size(kinds)).otherwise(0).cast("bigint").alias("n_found"),
                        F.when(some, kinds).otherwise(F.array().cast("array<string>")).alias("kinds"))
