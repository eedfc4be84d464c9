"""Format-preserving Feistel pseudonyms for personal data (operator 2).

Validated values are mapped by a keyed permutation of their own format: card
numbers stay valid under their check digit, dates stay dates of their century
in the same notation, telephone and social security numbers, IP addresses and
account numbers stay well formed. Equal values get equal pseudonyms in every
document. All of it is DataFrame work: one expression finds the candidates,
the text is split at them, and the pieces are joined with the pseudonyms.

Numbers go through a Feistel network with modular addition over a mixed radix
(p, q): each round maps (x, y) to (y, (x + F(key, round, y)) mod p) and swaps
the radices, a permutation of [0, p * q) whatever F is. Mail names go through
the same network over strings, adding within each character's class.

Edge cases: a null text stays null, an empty text stays empty; a value that
fails validation (check digit, calendar, octets, social security areas) is left
alone, as is all other text (domains of mail addresses, tokens and passwords too); whatever is written as a telephone
number is one; a document without values is unchanged. Very long texts are
handled whole. Repeated rows give one row each; other columns are not read.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 8
# Formats (Java regular expressions without groups), in the order in which they are tried.
MAIL = r"(?<![\w.%+-])[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,63})@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
ACCOUNT = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}[0-9A-Z]{11,30}(?![0-9A-Za-z])"
PHONE = r"(?<![0-9A-Za-z])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
SOCIAL = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
ISO_DATE = r"(?<![0-9A-Za-z./-])[0-9]{4}[-/.][0-9]{2}[-/.][0-9]{2}(?![0-9A-Za-z/-])"
DAY_DATE = r"(?<![0-9A-Za-z./-])[0-9]{2}[-/.][0-9]{2}[-/.][0-9]{4}(?![0-9A-Za-z/-])"
ADDRESS = r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z])"
CARD = r"(?<![0-9A-Za-z])[0-9]{13,19}(?![0-9A-Za-z])|(?<![0-9A-Za-z])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9A-Za-z])"
ANY = "|".join([MAIL, ACCOUNT, PHONE, SOCIAL, ISO_DATE, DAY_DATE, ADDRESS, CARD])


def _long(c: Column) -> Column:
    return c.cast("bigint")


def _draw(key: Column, tweak: Column, i: Column, y: Column) -> Column:
    """The round function: 60 bits of a keyed hash."""
    said = F.concat_ws("|", key, tweak, i.cast("string"), y.cast("string"))
    return _long(F.conv(F.substring(F.sha2(said.cast("binary"), 256), 1, 15), 16, 10))


def feistel(x: Column, p: Column, q: Column, key: Column | str, tweak: Column) -> Column:
    """Keyed permutation of [0, p * q); a key given as a string is the key itself."""
    key = F.lit(key) if isinstance(key, str) else key
    start = F.struct(F.call_function("div", _long(x), _long(q)).alias("x"),
                     _long(F.pmod(x, q)).alias("y"), _long(p).alias("p"), _long(q).alias("q"))
    turn = lambda s, i: F.struct(s.y.alias("x"), _long(F.pmod(s.x + _draw(key, tweak, i, s.y), s.p)).alias("y"),
                                 s.q.alias("p"), s.p.alias("q"))
    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, turn, lambda s: s.x * s.q + s.y)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _refill(m: Column, digits: Column) -> Column:
    """The match with its digits replaced one by one, all other characters kept."""
    chars = F.split(m, "")
    done = F.aggregate(chars, F.struct(F.lit("").alias("o"), F.lit(1).alias("k")), lambda s, c: F.when(
        c.rlike("[0-9]"), F.struct(F.concat(s.o, F.substr(digits, s.k, F.lit(1))).alias("o"), (s.k + 1).alias("k"))).otherwise(
        F.struct(F.concat(s.o, c).alias("o"), s.k.alias("k"))), lambda s: s.o)
    return done


def _pad(x: Column, n) -> Column:
    return F.lpad(x.cast("string"), n, "0")


def _luhn_sum(digits: Column, doubled_last: bool) -> Column:
    """Check sum from the right; doubled_last says whether the last digit counts double."""
    rev = F.split(F.reverse(digits), "")
    term = lambda c, i: F.when(F.pmod(i, F.lit(2)) == (0 if doubled_last else 1),
                               F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int"))
    return F.aggregate(F.transform(rev, term), F.lit(0), lambda a, b: a + b)


def _card(m: Column, key: Column) -> Column:
    d = _digits(m)
    body = F.substr(d, F.lit(1), F.length(d) - 1)
    n = F.length(body)
    half = _long(F.floor(n / 2))
    ten = lambda k: _long(F.round(F.pow(F.lit(10.0), k)))
    new = F.lpad(feistel(_long(body), ten(half), ten(n - half), key, F.concat(F.lit("card"), n.cast("string"))).cast("string"),
                 n, F.lit("0"))
    check = F.pmod(F.lit(10) - F.pmod(_luhn_sum(new, True), F.lit(10)), F.lit(10)).cast("string")
    return F.when((_luhn_sum(d, False) % 10 == 0) & ~d.rlike("^0+$"), _refill(m, F.concat(new, check)))


def _phone(m: Column, key: Column) -> Column:
    """Any ten digits are a number, whether or not an exchange has given it out."""
    d = _digits(m)
    own = F.right(d, F.lit(10))
    y = feistel(own.cast("bigint"), F.lit(1_000), F.lit(10_000_000), key, F.lit("phone"))
    return _refill(m, F.concat(F.substr(d, F.lit(1), F.length(d) - 10), _pad(y, 10)))


def _div(x: Column, n: int) -> Column:
    """Whole quotient of a non-negative number."""
    return F.call_function("div", x, F.lit(n).cast("bigint"))


def _social(m: Column, key: Column) -> Column:
    """Areas 001-899 without 666, groups 01-99, serials 0001-9999."""
    d = _digits(m)
    area, group, serial = (F.substr(d, F.lit(a), F.lit(n)).cast("bigint") for a, n in ((1, 3), (4, 2), (6, 4)))
    rank = F.when(area > 666, area - 2).otherwise(area - 1)
    y = feistel(rank * 989_901 + (group - 1) * 9_999 + serial - 1, F.lit(898), F.lit(989_901), key, F.lit("social"))
    a, r = _div(y, 989_901), F.pmod(y, F.lit(989_901))
    new = F.concat(_pad(F.when(a >= 665, a + 2).otherwise(a + 1), 3), _pad(_div(r, 9_999) + 1, 2), _pad(F.pmod(r, F.lit(9_999)) + 1, 4))
    return F.when((area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0), _refill(m, new))


def _address(m: Column, key: Column) -> Column:
    """An address with leading zeros in an octet is no address."""
    o = F.split(m, r"\.")
    part = lambda i: F.get(o, F.lit(i)).cast("bigint")
    y = feistel(part(0) * 16_777_216 + part(1) * 65_536 + part(2) * 256 + part(3), F.lit(65_536), F.lit(65_536), key, F.lit("address"))
    new = F.concat_ws(".", _div(y, 16_777_216), F.pmod(_div(y, 65_536), F.lit(256)), F.pmod(_div(y, 256), F.lit(256)), F.pmod(y, F.lit(256)))
    return F.when(F.forall(o, lambda x: (x.cast("int") < 256) & ~x.rlike("^0[0-9]")), new)


def _century(y: Column, m: Column, d: Column, key: Column, build) -> Column:
    """Permutes the days of the date's century: 36,524 = 92 * 397 days, or 36,525 = 75 * 487."""
    days = F.when(m == 2, F.when((y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0)), 29).otherwise(28)).when(
        m.isin(4, 6, 9, 11), 30).otherwise(31)
    valid = (y >= 1) & m.between(1, 12) & (d >= 1) & (d <= days)
    # the guard keeps make_date from seeing an impossible date
    date = F.when(valid, F.make_date(F.when(valid, y).otherwise(2000), F.when(valid, m).otherwise(1), F.when(valid, d).otherwise(1)))
    first = y - y % 100
    long_ = (first % 400 == 0)
    start = F.make_date(F.when(first < 100, 1).otherwise(first).cast("int"), F.lit(1), F.lit(1))
    x = F.datediff(date, start)
    p, q = F.when(long_, 75).otherwise(92), F.when(long_, 487).otherwise(397)
    new = F.date_add(start, feistel(x, p, q, key, F.concat(F.lit("date"), first.cast("string"))).cast("int"))
    return F.when(valid & (first >= 100), build(F.date_format(new, "yyyy"), F.date_format(new, "MM"), F.date_format(new, "dd")))


def _iso_date(m: Column, key: Column) -> Column:
    at = lambda a, n: F.substr(m, F.lit(a), F.lit(n)).cast("int")
    a, b = F.substr(m, F.lit(5), F.lit(1)), F.substr(m, F.lit(8), F.lit(1))
    return F.when(a == b, _century(at(1, 4), at(6, 2), at(9, 2), key, lambda y, mo, d: F.concat(y, a, mo, b, d)))


def _day_date(m: Column, key: Column) -> Column:
    """Month first between slashes where that is a date, else day first."""
    at = lambda a, n: F.substr(m, F.lit(a), F.lit(n)).cast("int")
    a, b = F.substr(m, F.lit(3), F.lit(1)), F.substr(m, F.lit(6), F.lit(1))
    month_first = (a == "/") & (at(1, 2) <= 12)
    mo, d = F.when(month_first, at(1, 2)).otherwise(at(4, 2)), F.when(month_first, at(4, 2)).otherwise(at(1, 2))
    return F.when(a == b, _century(at(7, 4), mo, d, key, lambda y, mm, dd: F.concat(
        F.when(month_first, mm).otherwise(dd), a, F.when(month_first, dd).otherwise(mm), b, y)))


def _classes(text: Column, key: Column, tweak: str) -> Column:
    """Feistel over a string: each half's characters are shifted within their class (digits, lower or upper case
    letters; others stay) by a keyed hash of the other half."""
    digits, lower, upper = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def shifted(part: Column, other: Column, i: Column) -> Column:
        seed = F.concat_ws("|", key, F.lit(tweak), i.cast("string"), F.length(part).cast("string"), other)
        bits = F.sha2(seed.cast("binary"), 512)

        def one(c: Column, k: Column) -> Column:
            v = F.conv(F.substr(bits, k * 3 % 120 + 1, F.lit(4)), 16, 10).cast("int") + k
            move = lambda s: F.substr(F.lit(s), F.pmod(F.instr(F.lit(s), c) - 1 + v, F.lit(len(s))) + 1, F.lit(1))
            return F.when(c.rlike("[0-9]"), move(digits)).when(c.rlike("[a-z]"), move(lower)).when(c.rlike("[A-Z]"), move(upper)).otherwise(c)

        return F.array_join(F.transform(F.split(part, ""), one), "")

    half = _long(F.floor(F.length(text) / 2)).cast("int")
    start = F.struct(F.substr(text, F.lit(1), half).alias("x"), F.substr(text, half + 1).alias("y"))
    turn = lambda s, i: F.when(i % 2 == 0, F.struct(shifted(s.x, s.y, i).alias("x"), s.y.alias("y"))).otherwise(
        F.struct(s.x.alias("x"), shifted(s.y, s.x, i).alias("y")))
    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, turn, lambda s: F.concat(s.x, s.y))


def _mail(m: Column, key: Column) -> Column:
    at = F.instr(m, "@")
    return F.concat(_classes(F.substr(m, F.lit(1), at - 1), key, "mail"), F.substr(m, at))


def _mod97(text: Column) -> Column:
    return F.aggregate(F.split(text, ""), F.lit(0), lambda a, c: F.when(
        c.rlike("[0-9]"), F.pmod(a * 10 + c.cast("int"), F.lit(97))).otherwise(F.pmod(a * 100 + F.ascii(c) - 55, F.lit(97))))


def _account(m: Column, key: Column) -> Column:
    """International account numbers: the part after the check digits is permuted and the check digits renewed."""
    land, check, own = F.substr(m, F.lit(1), F.lit(2)), F.substr(m, F.lit(3), F.lit(2)), F.substr(m, F.lit(5))
    new = _classes(own, key, "account")
    return F.when(_mod97(F.concat(own, land, check)) == 1,
                  F.concat(land, _pad(F.lit(98) - _mod97(F.concat(new, land, F.lit("00"))), 2), new))


def pseudonym(m: Column, key: Column) -> Column:
    """The pseudonym of one candidate, or null if it isn't a valid value."""
    whole = lambda p: m.rlike(f"^(?:{p})$")
    return (F.when(whole(MAIL), _mail(m, key)).when(whole(ACCOUNT), _account(m, key)).when(whole(PHONE), _phone(m, key))
            .when(whole(SOCIAL), _social(m, key)).when(whole(ISO_DATE), _iso_date(m, key)).when(whole(DAY_DATE), _day_date(m, key))
            .when(whole(ADDRESS), _address(m, key)).when(whole(CARD), _card(m, key)))


def make_key(spark: SparkSession, path: str) -> DataFrame:
    """The key table (one row, column ``key``) of a path that all executors share; one with a random key is written if there is
    none, so that values stay linked from run to run."""
    spark.createDataFrame([(secrets.token_hex(32),)], "key string").coalesce(1).write.mode("ignore").parquet(path)
    return spark.read.schema("key string").parquet(path)


def pseudonymise(docs: DataFrame, key: str | DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, n_values): the text with its valid values replaced, and how many there were. A key given as a table of one
    row is joined (broadcast), so that it stands in no plan or log; one given as a string is a literal of the plan."""
    body = F.col("_t")
    has = body.rlike("[0-9@]")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_t"))
    if isinstance(key, DataFrame):
        rows, key = rows.crossJoin(F.broadcast(key.select(F.col("key").alias("_k")))), F.col("_k")
    else:
        key = F.lit(key)
    found = rows.withColumn("_m", F.when(has, F.regexp_extract_all(body, F.lit(ANY), F.lit(0))))
    new = found.withColumn("_n", F.when(F.size("_m") > 0, F.transform("_m", lambda m: pseudonym(m, key))))
    pieces = F.zip_with(F.split(body, ANY, -1), F.zip_with("_n", "_m", lambda n, m: F.coalesce(n, m)),
                        lambda p, m: F.concat(p, F.coalesce(m, F.lit(""))))
    return new.select("doc_id", F.when(F.size("_m") > 0, F.array_join(pieces, "")).otherwise(body).alias("text"),
                      F.coalesce(F.size(F.filter("_n", lambda x: x.isNotNull())), F.lit(0)).cast("bigint").alias("n_values"))
