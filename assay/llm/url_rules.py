"""URL filters by pattern rules, each filed under its rarest literal token (operator 13).

A rule is a pattern over host and path. `||` stands for the beginning of the host or of one of its parent domains, `^` for
one character that is no letter or digit, or an end, `*` for anything, and all else for itself. So the site rule `example.com/en/`
is the pattern `||example.com/en/`: it fits example.com and its subdomains where the path begins with /en/. A word rule fits
hosts that hold its word between characters that are no letters or digits.

Matching never tries all rules on a URL:

1. A rule's literals are the runs of letters and digits in it that have an end on either side, so that a fitting URL holds them
   as whole tokens. How many different URLs hold each is counted, over all URLs, for the rules' literals alone.
2. A rule is filed under the one that fewest URLs hold. A rule without literals is filed under '', which every URL holds: it is
   tried on all of them, and nothing is lost.
3. The tokens of each different URL fetch their rules by an equi-join, and only those run their regular expression. The index is
   a table of known size, so it is broadcast if it is small and shuffled otherwise.
4. Of the rules that fit, site rules come before the others, and the longest wins; equal ones by text. One row a URL goes back
   to the rows of the table, in a join whose tables both are shuffled for it, so that adaptive execution can split a hot URL.

Defined results: a null URL, or one without ://, has an empty host and path; no rule fits it and the verdict is ALLOW, as for all
that no rule fits; only A-Z are lower-cased, in the host; ports and user names are part of the host, as the contract has it; rows
that share a URL get the same verdict, each its own row; an empty table gives an empty result; other columns take no part, but
for the keys that are asked for; very long URLs are read whole.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .divergence import ascii_lower
from .storage import materialise

ALLOW, BLOCK = "allow", "block"
# The site rules of the contract.
SITES = (("com/", ALLOW), ("example.com/en/", BLOCK), ("www.example.com/en/", ALLOW), ("net/es/", BLOCK), ("net/fr/", BLOCK))
#: Words of hosts that are blocked: gambling, adult content, spam and quick money, advertising and tracking, stolen goods.
WORDS = (
    "bet", "bets", "betting", "bingo", "casino", "casinos", "gambling", "jackpot", "lottery", "poker", "roulette", "slots",
    "adult", "camgirl", "escort", "escorts", "hentai", "nude", "nudes", "porn", "porno", "sex", "xxx",
    "cialis", "forex", "pills", "replica", "scam", "spam", "viagra", "payday", "clickbait",
    "ads", "adserver", "adservice", "adtrack", "banners", "popunder", "tracker", "tracking",
    "crack", "cracks", "keygen", "malware", "phishing", "warez",
)

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LETTERS = r"0-9a-z\x{80}-\x{10FFFF}"
TOKEN = f"[{LETTERS}]+"
#: A run in a pattern with an end on either side: neither a star nor the beginning or end of the pattern.
LITERAL = rf"(?<=[^{LETTERS}*])[{LETTERS}]+(?=[^{LETTERS}*])"
BEGIN, END = f"(?:^|[^{LETTERS}A-Z])", f"(?:[^{LETTERS}A-Z]|$)"
SITE, WORD, PATTERN = "site", "word", "pattern"


def host(url: str | Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")))


def path(url: str | Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def tokens(site: Column) -> Column:
    """The different tokens of a URL, in lower case, and ''."""
    return F.array_union(F.array(F.lit("")), F.regexp_extract_all(ascii_lower(site), F.lit(TOKEN), F.lit(0)))


def site_rules(spark: SparkSession, rules: Iterable[tuple[str, str]] = SITES) -> DataFrame:
    """(rule, verdict, pattern, kind) of rules `host/path`; one without a path fits all of a host."""
    made = spark.createDataFrame(list(rules), "rule string, verdict string")
    whole = F.when(F.instr("rule", "/") > 0, F.col("rule")).otherwise(F.concat("rule", F.lit("^")))
    return made.select("rule", "verdict", F.concat(F.lit("||"), whole).alias("pattern"), F.lit(SITE).alias("kind"))


def word_rules(spark: SparkSession, words: Iterable[str] = WORDS, verdict: str = BLOCK) -> DataFrame:
    """(rule, verdict, pattern, kind) of words of hosts; a rule may be several words, joined by hyphens or dots."""
    made = spark.createDataFrame([(w,) for w in words], "rule string")
    return made.select("rule", F.lit(verdict).alias("verdict"), F.concat(F.lit("^"), "rule", F.lit("^")).alias("pattern"), F.lit(WORD).alias("kind"))


def pattern_rules(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """(rule, verdict, pattern, kind) of patterns over host and path."""
    made = spark.createDataFrame(list(rules), "rule string, verdict string")
    return made.select("rule", "verdict", F.col("rule").alias("pattern"), F.lit(PATTERN).alias("kind"))


def regex(pattern: str = "pattern", kind: str = "kind") -> Column:
    """The regular expression of a pattern, over host and path; that of a word stays within the host."""
    domain = F.startswith(F.col(pattern), F.lit("||"))
    body = F.when(domain, F.substr(F.col(pattern), F.lit(3))).when(F.col(kind) == WORD, F.btrim(F.col(pattern), F.lit("^"))).otherwise(F.col(pattern))
    plain = F.regexp_replace(body, r"([\p{Punct}&&[^*^]])", r"\\$1")
    # the parts that a ^ becomes hold a ^ themselves
    marked = F.replace(F.replace(plain, F.lit("*"), F.lit(".*")), F.lit("^"), F.lit("\x01"))
    begun = F.when(F.startswith(marked, F.lit("\x01")), F.concat(F.lit(BEGIN), F.substr(marked, F.lit(2)))).otherwise(marked)
    ended = F.replace(begun, F.lit("\x01"), F.lit(END))
    within = F.concat(F.lit(f"^(?:[^/]*[^{LETTERS}/])?"), ended, F.lit(END))
    return F.when(F.col(kind) == WORD, within).when(domain, F.concat(F.lit(r"(?s)^(?:[^/]*\.)?"), ended)).otherwise(F.concat(F.lit("(?s)"), ended))


def index(rules: DataFrame, urls: DataFrame, url: str = "url") -> DataFrame:
    """(token, rule, verdict, regex, kind): each rule under that of its literals which fewest of the URLs hold."""
    parsed = rules.select("rule", "verdict", "pattern", "kind", F.array_distinct(F.regexp_extract_all(ascii_lower("pattern"), F.lit(LITERAL), F.lit(0))).alias("literals"))
    # a table of known size, so that the tokens of URLs are sifted where they are, as long as the rules are few
    literals, _ = materialise(parsed.select("rule", "pattern", F.explode("literals").alias("token")), "url-literals")
    held = urls.select(F.explode(tokens(F.concat(host(url), path(url)))).alias("token")).join(literals.select("token").distinct(), "token", "left_semi")
    counts = held.groupBy("token").agg(F.count("*").alias("_n"))
    rarest = literals.join(counts, "token", "left").groupBy("rule", "pattern").agg(F.min_by("token", F.struct(F.coalesce("_n", F.lit(0)), -F.char_length("token"), "token")).alias("token"))
    filed = parsed.join(rarest, ["rule", "pattern"], "left")
    return filed.select(F.coalesce("token", F.lit("")).alias("token"), "rule", "verdict", regex().alias("regex"), "kind")


def fitting(urls: DataFrame, filed: DataFrame, url: str = "url") -> DataFrame:
    """(url, best): of the rules that fit each different URL the one that wins, as (is_site, length, rule, verdict)."""
    sites = urls.select(F.col(url), F.concat(host(url), path(url)).alias("_site"))
    candidates = sites.select(url, "_site", F.explode(tokens(F.col("_site"))).alias("token")).join(filed, "token")
    fits = candidates.where(F.rlike("_site", F.col("regex")))
    return fits.groupBy(url).agg(F.max(F.struct((F.col("kind") == SITE).alias("is_site"), F.char_length("rule").alias("length"), "rule", "verdict")).alias("best"))


def judge(pages: DataFrame, keys: list[str], rules: DataFrame | None = None, url: str = "url") -> DataFrame:
    """keys, host, path, rule (of the site rule that wins, else null), pattern_rule (of another), verdict of every row."""
    spark = pages.sparkSession
    rules = site_rules(spark).unionByName(word_rules(spark)) if rules is None else rules
    named = pages.select(*[F.col(k) for k in keys], F.col(url).alias("_url"))
    different = pages.select(F.col(url).alias("url")).where("url IS NOT NULL").distinct()
    filed, _ = materialise(index(rules, different), "url-rules")
    # one row a URL, but shuffled anew for the join below, together with a hash, so that both of its sides can be split
    found = fitting(different, filed).select(F.xxhash64("url").alias("_k"), F.col("url").alias("_url"), "best")
    judged = named.withColumn("_k", F.xxhash64("_url")).join(found, ["_k", "_url"], "left")
    by_site = F.coalesce(F.col("best.is_site"), F.lit(False))
    return judged.select(
        *keys,
        host("_url").alias("host"),
        path("_url").alias("path"),
        F.when(by_site, F.col("best.rule")).alias("rule"),
        F.when(~by_site, F.col("best.rule")).alias("pattern_rule"),
        F.coalesce(F.col("best.verdict"), F.lit(ALLOW)).alias("verdict"),
    )
