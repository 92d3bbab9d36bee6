"""Source divergence, filter interaction and URL rules against plain restatements, with nulls, ties, repeats and empty tables."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pyarrow as pa
from pyspark.sql import functions as F

from assay.llm import divergence, filter_lattice, url_rules
from tests.llm.brute import LOWER, words

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_divergence(docs, least=3, top=200):
    """The contract, one group and one term at a time; docs are (text, lang, source)."""
    groups, held = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        found = TERM.findall((text or "").translate(LOWER))
        groups[lang or "", source or ""].update(found)
        held[lang or ""].update(set(found))
    out = []
    for lang in held:
        kept = {t for t, n in held[lang].items() if n >= least}
        own = {s: Counter({t: n for t, n in c.items() if t in kept}) for (la, s), c in groups.items() if la == lang}
        whole = sum(own.values(), Counter())
        p = lambda c, t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))  # noqa: B023,E731
        f = lambda a, b: (a - b) * (a - b) // b
        for s in own:
            pairs = sorted(((-sum(f(p(own[s], t), p(own[o], t)) for t in kept), o) for o in own if o != s), key=lambda x: (x[0], x[1].encode()))
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, o) in enumerate(pairs)]
            over = sorted(((-f(p(own[s], t), p(whole, t)), t) for t in kept if own[s][t] and p(own[s], t) > p(whole, t)), key=lambda x: (x[0], x[1].encode()))
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, t) in enumerate(over[:top])]
    return sorted(out)


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


AUDIT = ("lang", "source", "part", "item", "value", "rank")


def test_divergence_equals_plain_restatement(spark):
    rng = random.Random(1)
    vocabulary = ["Alpha", "beta", "BETA", "gämma", "Ä", "ä", "x1y", "don't", "中文", "zeta", "\u00d7", "Éa", "q"]
    docs = [(" ".join(rng.choices(vocabulary, k=rng.randint(0, 30))), rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "Z", "é", None])) for _ in range(120)]
    docs += [(None, "en", "empty"), ("", "en", "empty"), ("1 2 3", None, "digits"), ("only here", "xx", "a"), ("other words", "xx", "b"), (None, "yy", None)]
    docs += [docs[0]] * 3
    table = spark.createDataFrame([(i, t, la, s, 0, "x", 1) for i, (t, la, s) in enumerate(docs)], DOCS + ", term string, n int")
    assert rows(divergence.audit(table), *AUDIT) == plain_divergence(docs)
    assert rows(divergence.audit(table, top=2), *AUDIT) == plain_divergence(docs, top=2)


def test_divergence_without_kept_terms_and_without_rows(spark):
    docs = [("a b", "en", "s"), ("c", "en", "t"), (None, "en", None)]
    table = spark.createDataFrame([(i, t, la, s, 0) for i, (t, la, s) in enumerate(docs)], DOCS)
    assert rows(divergence.audit(table), *AUDIT) == plain_divergence(docs)
    assert divergence.audit(table.limit(0)).columns == list(AUDIT)
    assert divergence.audit(table.limit(0)).count() == 0


def test_terms_are_counted_within_batches(spark, monkeypatch):
    """No row for each match: the counts of a batch are what the grouping gets, also where a batch goes in several parts."""
    docs = [("Aa é\u00c9x a", "en", "s"), (None, "en", None), ("a " * 500 + "aa", "en", "s"), ("", None, "t"), ("aa-b\U0001f600C\x7fd", "", "t")] * 3
    table = spark.createDataFrame([(i, t, la, s, 0) for i, (t, la, s) in enumerate(docs)], DOCS)
    want = defaultdict(lambda: [0, 0])
    for text, lang, source in docs:
        found = TERM.findall((text or "").translate(LOWER))
        for t in [*found, ""]:
            want[lang or "", source or "", t][0] += t != ""
        for t in set(found):
            want[lang or "", source or "", t][1] += 1
    counts = divergence.term_counts(table)
    assert "Generate" not in counts._jdf.queryExecution().executedPlan().toString()
    assert {(r.lang, r.source, r.term): [r.n, r.df] for r in counts.collect()} == want
    monkeypatch.setattr(divergence, "CHUNK", 1)
    batch = pa.RecordBatch.from_pylist([{"lang": la or "", "source": s or "", "text": t} for t, la, s in docs])
    got = defaultdict(lambda: [0, 0])
    for part in divergence._counted(batch):
        for r in part.to_pylist():
            got[r["lang"], r["source"], r["term"]] = [got[r["lang"], r["source"], r["term"]][k] + r[c] for k, c in enumerate(("n", "df"))]
    assert got == want


def test_divergence_is_exact_beyond_a_long(spark):
    got = spark.range(1).select(F.lit(4_000_000_000_000).alias("n"), F.lit(9_000_000_000_000).alias("t"), F.lit(7).alias("v")).select(divergence.share("n", "t", "v").alias("p")).first().p
    assert got == 1 + 10**9 * (4_000_000_000_000 + 1) // (9_000_000_000_000 + 7)


def plain_lattice(docs, labels):
    """The contract, one order and one document at a time; docs are (doc_id, text, lang)."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(least.get(t or "", d), d)
    fails, parts = [], defaultdict(list)
    for i, (d, t, lang) in enumerate(docs):
        t, w = t or "", words(t)
        caps = sum("A" <= c <= "Z" for c in t)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * caps > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and d > least[t]}
        fails.append({k for k, v in f.items() if v})
        parts[lang or ""].append(i)
    out = []
    for part, some in parts.items():
        made, total = [], Counter()
        for order in permutations("ABCDE"):
            there = set(some)
            for step, f in enumerate(order):
                gone = {i for i in there if f in fails[i]}
                hit = {i for i in some if f in fails[i]}
                there -= gone
                total[f] += len(gone)
                made.append((part, "".join(order), step + 1, len(there), len(gone), len(hit - gone), sum(fails[i] == {f} for i in some), sum(docs[i][0] in good for i in gone), sum(docs[i][0] in toxic for i in gone)))
        out += [(*m, total[m[1][m[2] - 1]]) for m in made]
    return sorted(out)


LATTICE = ("part", "filter_order", "step", *filter_lattice.COUNTS, "shapley")


def test_lattice_equals_walking_all_orders(spark):
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(k)}" for _ in range(n)) + tail for k in (20, 400) for n in (150, 199, 200, 300) for tail in ("", " #", " " + "A" * 40)]
    docs = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(60)]
    docs += [(7, docs[7][1], "en"), (None, docs[3][1], "en"), (None, docs[3][1], "de"), (90, None, "en"), (91, "", "en"), (92, "word " * 30_000, "fr"), (93, "É" * 300, "fr")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 60, 2)] + [(0, 1, 1), (0, 0, 0), (None, 1, 1)]
    table = spark.createDataFrame([(d, t, la, "s", 0, 9, 9) for d, t, la in docs], DOCS + ", mask int, part int")
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = rows(filter_lattice.audit(table, said), *LATTICE)
    assert got == plain_lattice(docs, labels)
    assert len(got) == 600 * 3 + 600
    assert filter_lattice.audit(table.limit(0), said).count() == 0


def test_lattice_has_an_edge_for_each_set_and_filter():
    found = filter_lattice.edges(5)
    assert len(found) == len(set(found)) == 80


def plain_verdict(url, sites=url_rules.SITES, blocked=url_rules.WORDS):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (m[1].translate(LOWER), m[2]) if m else ("", "")
    fit = [(len(r), r, v) for r, v in sites for h, p in [(r.partition("/")[0], "/" + r.partition("/")[2])] if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fit:
        return host, path, max(fit)[1], None, max(fit)[2]
    word = max(((len(t), t) for t in re.findall(r"[0-9a-z\x80-\U0010FFFF]+", host) if t in blocked), default=None)
    return host, path, None, word and word[1], "block" if word else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://com", "http://com/", "HTTP://WWW.Example.COM/en/", "http://www.example.com/en", "http://www.example.com/en/1", "http://a.www.example.com/en/1", "http://x.example.com/en/?q", "http://example.com/EN/1",
    "http://notexample.com/en/", "http://a.net/es/1", "http://a.net/fr/", "http://net/fr/x", "http://anet/fr/x", "http://a.net/de/", "http://a.net:80/es/", "http://casino-win.org/x", "http://a.casino.org/x", "http://casinox.org/", "http://x.org/casino/",
    "https://free-bets.org?u=http://a.com/", "http://ads.spam.org#f", "http://a.com//en/", "ftp://user@sex.org/", "x://y://z.com/", "http://ÄÉ.org/casino", "http://écasino.org/", "http://casino.com/", "http://a\nb.casino.org/\nx", "http://poker.net/es/", "http://a.org/" + "x/" * 5000, "http://pills.org/../com/",
]


def test_url_rules_equal_trying_every_rule(spark):
    table = spark.createDataFrame([(i % 30, u, "h", 1) for i, u in enumerate(URLS + URLS[:9])], "page_id long, url string, host string, rule int")
    got = rows(url_rules.judge(table, ["page_id"]).fillna("-", ["rule", "pattern_rule"]), "page_id", "host", "path", "rule", "pattern_rule", "verdict")
    assert got == sorted((i % 30, h, p, r or "-", w or "-", v) for i, u in enumerate(URLS + URLS[:9]) for h, p, r, w, v in [plain_verdict(u)])
    assert url_rules.judge(table.limit(0), ["page_id"]).count() == 0


def test_rules_are_filed_under_their_rarest_literal(spark):
    urls = spark.createDataFrame([("http://example.com/en/1",), ("http://example.com/de/1",), ("http://example.org/en/2",), ("http://other.com/x/y-z/",)], "url string")
    rules = url_rules.site_rules(spark, [("example.com/en/", "block"), ("com/", "allow"), ("example", "block"), ("none.example.com/", "block")])
    rules = rules.unionByName(url_rules.pattern_rules(spark, [("en", "block"), ("*x/y-z^", "block"), ("foo*bar", "block")]))
    found = {r.rule: r.token for r in url_rules.index(rules, urls).collect()}
    # en is in two URLs, com and example in three; a literal in none is rarest; an end without a separator is no token
    assert found == {"example.com/en/": "en", "com/": "com", "example": "example", "none.example.com/": "none", "en": "", "*x/y-z^": "y", "foo*bar": ""}


def test_patterns_and_rules_without_literals(spark):
    urls = spark.createDataFrame([(i, u) for i, u in enumerate(["http://a.org/print/1", "http://a.org/sprint/1", "http://b.a.org/print", "http://c.org/x.php", "http://c.org/xaphp", "http://c.org/foo/9/bar", "http://d.org/(1)+"])], "page_id long, url string")
    rules = url_rules.pattern_rules(spark, [("||a.org/print^", "block"), ("x.php", "block"), ("foo*bar", "block"), ("(1)+", "block"), ("^print^", "allow")])
    got = {r.page_id: (r.pattern_rule, r.verdict) for r in url_rules.judge(urls, ["page_id"], rules).collect()}
    assert got == {0: ("||a.org/print^", "block"), 1: (None, "allow"), 2: ("||a.org/print^", "block"), 3: ("x.php", "block"), 4: (None, "allow"), 5: ("foo*bar", "block"), 6: ("(1)+", "block")}
