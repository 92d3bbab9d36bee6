"""Text cleaning and extraction as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._columns import Text, col
from .names import strip

# Shorthand tags and what they say in words, applied in this order.
TAG_WORDS = [
    (r"\blanguage:\s*en\b", "language: English"),
    (r"\blanguage:\s*de\b", "language: German"),
    (r"\blanguage:\s*fr\b", "language: French"),
    (r"\blanguage:\s*es\b", "language: Spanish"),
    (r"\blanguage:\s*zh\b", "language: Chinese"),
    (r"\blanguage:\s*ja\b", "language: Japanese"),
    (r"\blanguage:\s*ar\b", "language: Arabic"),
    (r"\bformat:\s*parquet\b", "data format: parquet"),
    (r"\bformat:\s*csv\b", "data format: CSV"),
    (r"\bformat:\s*json\b", "data format: JSON"),
    (r"\bformat:\s*jsonl\b", "data format: JSONL"),
    (r"\bmodality:\s*text\b", "data modality: text"),
    (r"\bmodality:\s*tabular\b", "data modality: tabular"),
    (r"\bmodality:\s*image\b", "data modality: image"),
    (r"\btask_categories:\s*", "task category: "),
    (r"\btask_ids:\s*", "task: "),
    (r"\bsize_categories:\s*", "dataset size category: "),
    (r"\bsource_datasets:\s*", "source dataset: "),
    (r"\bmultilinguality:\s*monolingual\b", "the dataset is monolingual"),
    (r"\bmultilinguality:\s*multilingual\b", "the dataset is multilingual"),
]
# Reference sections, then citation marks, and what is left of white space.
REFERENCE_SECTIONS = [
    r"(?is)\n\s*(?:References?|Bibliography|Literature\s+Cited?)\s*\n.*",
    r"(?is)\n\s*\d+\.\s*References?\s*\n.*",
    r"(?is)\n\s*\[\d+\].*?(?=\n\s*\[|\n\s*\d+\.|\z)",
    r"(?is)\n\s*References?\s*\n\s*\[.*",
    r"(?is)\n\s*Bibliography\s*\n.*",
]
CITATIONS = [r"(?m)\[\d+(?:,\s*\d+)*\]", r"(?m)\(\d+\)", r"(?m)\b\d+\.\s*[A-Z].*?(?=\n\s*\d+\.|\z)"]


def _apply(x: Column, rules: list[tuple[str, str]]) -> Column:
    return reduce(lambda c, r: F.regexp_replace(c, r[0], r[1]), rules, x)


def tokens(x: Text) -> Column:
    """Lower-cased words in Unicode letters, digits and `_`."""
    return F.regexp_extract_all(F.lower(col(x)), F.lit(r"(?U)\b\w+\b"), 0)


def expand_tags(x: Text) -> Column:
    """Shorthand tags such as language:en in words."""
    return _apply(col(x), [("(?i)" + p, w) for p, w in TAG_WORDS])


def strip_references(x: Text) -> Column:
    """Without reference sections, citation marks and numbered references; white space squeezed."""
    return strip(F.regexp_replace(_apply(col(x), [(p, "") for p in [*REFERENCE_SECTIONS, *CITATIONS]]), r"\n\s*\n\s*\n", "\n\n"))


def keywords(statement: Text, sort: bool = True) -> Column:
    """Distinct terms of more than 2 characters for a keyword search: quotations, URLs, numbers, names and technical terms."""
    clean = F.regexp_replace(F.regexp_replace(col(statement), r"(?i)^(The|A|An)\s+", ""), r"(?i)(is|are|was|were|has|have)\s+", " ")
    # The five families of terms.
    found = [
        F.regexp_extract_all(clean, F.lit(r'(?i)"([^"]+)"'), 1),
        F.regexp_extract_all(clean, F.lit(r"(?i)https?://[^\s]+"), 0),
        F.regexp_extract_all(clean, F.lit(r"(?i)\b\d+[,\d]*(?:\.\d+)?\s*(?:k|K|thousand|million|%|examples?|MB|GB)?\b"), 0),
        F.regexp_extract_all(clean, F.lit(r"(?i)\b[A-Z][a-zA-Z]+(?:\s+[A-Z][a-zA-Z]+)*\b"), 0),
        F.transform(F.regexp_extract_all(clean, F.lit(r"(?i)\b(?:benchmark|dataset|accuracy|license|MIT|JSON|API|NLP|AI|BERT|model)\b"), 0), F.lower),
    ]
    out = F.array_distinct(F.filter(F.transform(F.concat(*found), strip), lambda k: F.length(k) > 2))
    return F.array_sort(out) if sort else out


def arxiv_url(tags: Text, readme: Text) -> Column:
    """A paper's address: from an arxiv: tag, a "Paper:" link, a BibTeX block, or any arXiv address in the text."""
    text = col(readme)
    at = lambda i: F.when(F.length(i) > 0, F.concat(F.lit("https://arxiv.org/abs/"), i))
    tag = F.get(F.filter(F.transform(F.filter(col(tags), lambda t: t.startswith("arxiv:")), lambda t: F.trim(F.substr(t, F.lit(7)))), lambda t: t != ""), F.lit(0))
    link = F.regexp_replace(F.regexp_extract(text, r"(?i)\*{0,2}Paper\*{0,2}\s*[:：]\s*(https?://\S+)", 1), r"\)+$", "")
    block = F.get(F.filter(F.transform(F.regexp_extract_all(text, F.lit(r"(?is)```bibtex(.*?)```"), 1), lambda b: F.regexp_extract(b, r"(?i)arxiv[:\s.]*(\d{4}\.\d{4,5})", 1)), lambda i: i != ""), F.lit(0))
    return F.coalesce(at(tag), F.when(link != "", link), at(block), at(F.regexp_extract(text, r"https?://arxiv\.org/(?:abs|pdf)/(\d{4}\.\d{4,5})", 1)))


def paper_url(url: Text) -> Column:
    """An address that a converter can read, or null."""
    low = F.lower(col(url))
    return F.when(low.contains("semanticscholar.org"), F.lit(None)).when(low.contains("aclanthology.org") & ~low.endswith(".pdf"), F.concat(F.regexp_replace(col(url), "/+$", ""), F.lit(".pdf"))).otherwise(col(url))


def is_pdf_url(url: Text) -> Column:
    low = F.lower(col(url))
    return low.endswith(".pdf") | low.contains("arxiv.org")


def is_html_url(url: Text) -> Column:
    low = F.lower(col(url))
    ends = reduce(lambda a, b: a | b, [low.endswith(e) for e in (".pdf", ".json", ".jsonl")])
    return low.startswith("http") & ~low.contains("arxiv.org") & ~ends


def best_paper_url(arxiv_id: Text, doi: Text, url: Text) -> Column:
    """arXiv before DOI before another address that is no Semantic Scholar page."""
    given = lambda c: F.when(F.length(col(c)) > 0, col(c))
    return F.coalesce(F.concat(F.lit("https://arxiv.org/abs/"), given(arxiv_id)), F.when(given(doi).startswith("http"), given(doi)).otherwise(F.concat(F.lit("https://doi.org/"), given(doi))), F.when(~col(url).contains("semanticscholar.org"), given(url)))


def html_title(html: Text, url: Text) -> Column:
    """The title element, else the host."""
    title = strip(F.regexp_replace(F.regexp_extract(col(html), r"(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " "))
    return F.when(title != "", title).otherwise(F.parse_url(col(url), F.lit("HOST")))


def strip_thinking(x: Text) -> Column:
    return strip(F.regexp_replace(col(x), r"(?s)<think>.*?</think>", ""))


def json_array(x: Text) -> Column:
    """What lies from the first `[` to the last `]`, as numbers; entries that are none are 0."""
    return F.transform(F.from_json(F.regexp_extract(col(x), r"(?s)\[.*\]", 0), "array<string>"), lambda v: F.coalesce(F.expr("try_cast(NULL AS DOUBLE)"), v.try_cast("double"), F.lit(0.0)))


def first_object(x: Text, greedy: bool = True) -> Column:
    return F.nullif(F.regexp_extract(col(x), r"(?s)\{.*\}" if greedy else r"(?s)\{.*?\}", 0), F.lit(""))


def description(doc: Text, limit: int = 280) -> Column:
    """The first line of a documentation text, cut."""
    return F.substring(strip(F.get(F.split(strip(doc), "\n"), F.lit(0))), 1, limit)


def markdown_title(x: Text) -> Column:
    return strip(F.regexp_extract(col(x), r"(?m)^## (.+)$", 1))


def checklist_item(line: Text) -> Column:
    """The name in an unticked item of a Markdown list, else null."""
    return F.nullif(strip(F.regexp_extract(col(line), r"^\s*- \[ \]\s*(.+)$", 1)), F.lit(""))


def abstract_from_index(index: Text) -> Column:
    """The text of an inverted index {word: positions}."""
    pairs = F.flatten(F.transform(F.map_entries(col(index)), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("at"), e["key"].alias("word")))))
    return F.array_join(F.transform(F.array_sort(pairs), lambda s: s["word"]), " ")


def section(facts: Text, heading: str) -> Column:
    """The lines under `## heading` up to the next heading."""
    return strip(F.regexp_extract(col(facts), rf"(?is)(?:^|\n)##\s*{heading}[^\n]*\n(.*?)(?=\n##|\z)", 1))


def targeted_paragraphs(text: Text, label: Text, header: int = 2) -> Column:
    """Paragraphs that hold all words of a label, with their neighbours, after the first paragraphs of the text."""
    parts = F.filter(F.split(col(text), "\n\n"), lambda p: F.length(strip(p)) > 0)
    wanted = F.filter(F.split(F.lower(col(label)), r"\s+"), lambda w: w != "")
    near = lambda i, d: F.forall(wanted, lambda w: F.lower(F.coalesce(F.get(parts, i + d), F.lit(""))).contains(w))
    return F.array_join(F.filter(parts, lambda p, i: (i < header) | near(i, 0) | near(i, -1) | near(i, 1)), "\n\n")
