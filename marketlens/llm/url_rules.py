"""URL filters indexed by the rarest literal token (operator 6).

A rule is a regular expression over the url's host and path with the literal
tokens it needs. Each rule is filed under the one of its tokens that the fewest
urls have; a url's tokens fetch the rules filed under them, and only those run
their expressions. All of it is DataFrame work.

Edge cases: a null url or one without '://' has an empty host and path and is
judged by the method (allow). Equal urls are judged once and joined back.
Rules without a token are filed under the empty token, which every url has. An
empty rule table leaves everything to the method; an empty page table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rules up to this many are broadcast (a few hundred bytes each); more are joined by shuffling.
BROADCAST_RULES = 50_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The method's own rules where no list rule fits: host words of unwanted sites.
UNWANTED_HOST_WORDS = ("adult", "ads", "adserver", "bet", "bets", "betting", "casino", "escort", "gambling", "malware",
                       "phishing", "pills", "poker", "porn", "sex", "spam", "torrent", "track", "tracker", "viagra",
                       "warez", "xxx")


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def _quote(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def _tokens(text: str) -> list[str]:
    """Runs of ASCII letters and digits."""
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text).split()


def list_rule(host: str, path: str, action: str) -> tuple[str, str, str, int, list[str]]:
    """(rule, action, expression, rank, tokens) of a host and path rule. The expression is matched against
    host, U+0001, path. The path's last run of letters and digits may go on in the url, so it is no token."""
    whole = _tokens(host) + (_tokens(path) if path and not path[-1].isalnum() else _tokens(path)[:-1])
    return host + path, action, f"^(?s:.*\\.)?{_quote(host)}\\x01{_quote(path)}", len(host + path), whole


def word_rule(word: str, action: str = "block") -> tuple[str, str, str, int, list[str]]:
    """A rule of the method: a word of the host. Every list rule outranks it."""
    return word, action, f"^(?s:[^\\x01]*[^a-z0-9\\x01])?{_quote(word)}([^a-z0-9]|$)", -1, [word]


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str, int, list[str]]]) -> DataFrame:
    """Rules as a frame of literals (rule, action, pattern, rank, tokens)."""
    schema = "array<struct<rule:string,action:string,pattern:string,rank:int,tokens:array<string>>>"
    rows = [F.struct(*[F.lit(x) for x in r[:4]], F.array(*[F.lit(t) for t in r[4]]).cast("array<string>")) for r in rules]
    return spark.range(1).select(F.inline(F.array(*rows).cast(schema)))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """(url, host, path, rule, action, rank) per distinct url; rule, action and rank of the highest ranked rule that fits
    (ties by the smaller rule), or null."""
    host, path = host_path(F.col("url"))
    urls = pages.select(F.col(url).alias("url")).distinct().select("url", host.alias("host"), path.alias("path"))
    tokens = urls.select("url", "host", "path", F.explode(F.array_distinct(F.concat(
        F.array(F.lit("")), F.regexp_extract_all(F.concat_ws(" ", "host", "path"), F.lit("[0-9A-Za-z]+"), F.lit(0))))).alias("token"))
    named = rules.withColumn("token", F.explode(F.when(F.size("tokens") > 0, F.array_distinct("tokens")).otherwise(F.array(F.lit("")))))
    wanted = named.select("token").distinct()
    n_rules = rules.count()
    small = (lambda d: F.broadcast(d)) if n_rules <= broadcast_rules else (lambda d: d)
    use = tokens.join(small(wanted), "token", "left_semi").groupBy("token").count()
    filed = named.join(use, "token", "left").groupBy("rule", "action", "pattern", "rank").agg(
        F.min_by("token", F.struct(F.coalesce("count", F.lit(0)), F.col("token"))).alias("token"))
    fits = tokens.join(small(filed), "token").where(F.expr("concat(host, '\\u0001', path) rlike pattern")).groupBy(
        F.col("url").alias("_u")).agg(
        F.min_by(F.struct("rule", "action", "rank"), F.struct(-F.col("rank"), F.col("rule"))).alias("_r"))
    return urls.join(fits, F.col("url").eqNullSafe(F.col("_u")), "left").select(
        "url", "host", "path", "_r.rule", "_r.action", "_r.rank")


def filter_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict, method_rule): rule only where a list rule decided."""
    j = judge_urls(pages, rules, url).withColumnRenamed("url", "_url")
    p = pages.select(F.col(key).alias("page_id"), F.col(url).alias("_page_url"))
    listed = F.col("rank") >= 0
    return p.join(j, F.col("_page_url").eqNullSafe(F.col("_url")), "left").select(
        "page_id", "host", "path", F.when(listed, F.col("rule")).alias("rule"),
        F.coalesce("action", F.lit(default)).alias("verdict"),
        F.when(~listed, F.col("rule")).alias("method_rule"))
