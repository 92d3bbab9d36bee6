"""Decontamination: recall of re-parameterised items, short items, copies with one edited value, many items on one window."""

from __future__ import annotations

import random
import re

import pytest

from assay.llm import decontaminate
from tests.llm.test_filters import found

PEOPLE, CITIES, UNITS = ["Alice", "Boris", "Carla", "Dmitri", "Elena", "Farid"], ["Paris", "Oslo", "Lima", "Cairo"], [["miles", "km", "meters"], ["kg", "pounds", "grams"], ["hours", "minutes", "days"]]
STEMS = [
    "{p} walks {n} {u0} to the old market in {c} and buys {m} apples there",
    "{p} has {n} apples and gives {m} of them to {q} before the train leaves",
    "A farmer named {p} keeps {n} brown hens that lay {m} eggs in {k} {u2} every summer",
    "If {n} workers need {m} {u2} to paint the wall, how long do {k} workers need for it?",
    "The box weighs {n} {u1} more than the bag that {p} carries from {c} to the river",
    "{p} and {q} share {n} marbles so that {p} gets {m} more than {q} in the end",
    "On the table there are {n} red cubes, {m} blue cubes and one wooden ball from {c}",
    "A tank of {n} liters loses {m} liters in {k} {u2}. How much is left in the tank after that?",
]


def filled(rng, stem):
    people = rng.sample(PEOPLE, 2)
    values = {"p": people[0], "q": people[1], "c": rng.choice(CITIES), **dict(zip("nmk", rng.sample([str(rng.randint(100, 999)), f"{rng.randint(2, 99)}.5", str(rng.randint(13, 39)), "twelve", "forty"], 3), strict=True)), **{f"u{i}": rng.choice(u) for i, u in enumerate(UNITS)}}
    return stem.format(**values)


def test_recall_of_reparameterised_items(spark):
    rng = random.Random(1)
    items = [filled(rng, s) for s in STEMS]
    filler = lambda n: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n)) + "."
    texts = [f"{filler(20)} {filled(rng, s)} {filler(20)}" for s in STEMS for _ in range(12)] + [filler(60) for _ in range(100)]
    got, _, _ = found(spark, texts, items)
    hit = sum(any(x["item_id"] == 100 + i // 12 for x in got[i]) for i in range(len(STEMS) * 12))
    assert hit >= 0.9 * len(STEMS) * 12
    assert not any(got[i] for i in range(len(STEMS) * 12, len(texts)))


@pytest.mark.parametrize(("item", "text"), [
    ("Alice has 12 apples and gives them all to her friend", "Mary Ann has 7 apples and gives them all to her friend"),
    ("Alice has 12 apples and gives them all away", "Carla has 40 apples and gives them all away"),
    ("A runner needs 300 km of training before the race", "A runner needs 200km of training before the race"),
])
def test_names_and_units_of_other_shape(spark, item, text):
    got, _, _ = found(spark, [f"Some words before. {text} and after."], [item])
    assert [x["kind"] for x in got[0]] == ["reparameterised"]


def test_short_items_are_whole_lines(spark):
    got, _, _ = found(spark, ["intro\n Is water WET? \nmore", "he asked: is water wet?", "Is water wet", "is\nwater wet?", None], ["Is water wet?"])
    assert [bool(got[i]) for i in range(5)] == [True, False, True, False, False]
    assert (got[0][0]["from_word"], got[0][0]["to_word"]) == (1, 4)


def test_a_long_copy_with_one_edited_value_is_found(spark):
    item = "There are 7 red cubes on the table and " + " ".join(f"word{i}" for i in range(25)) + " and then 7 blue cubes under the wide old table there."
    texts = [re.sub("7 blue", "9 blue", item), item.replace("7", "9")]
    got, _, _ = found(spark, texts, [item])
    assert [x["kind"] for x in got[0]] == ["verbatim"]
    assert got[0][0]["n_words"] >= decontaminate.VERBATIM
    assert [x["kind"] for x in got[1]] == ["reparameterised"]


def hints(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(100 + i, t) for i, t in enumerate(items)], "item_id long, text string")
    return {r["doc_id"]: (r["found"], r["hints"]) for r in decontaminate.find(docs, bench, ["doc_id"], hints=True).collect()}, docs, bench


def test_short_items_inside_lines_are_hints(spark):
    texts = ["he asked: is water wet?", "is\nwater wet?", "Is water wet?\nhe asked: is water wet", "water is wet", None, "", "so is water wet and is water wet", "Oslo"]
    got, docs, bench = hints(spark, texts, ["Is water wet?", "Oslo"])
    assert {d: [(x["item_id"], x["kind"], x["from_word"], x["to_word"]) for x in h] for d, (_, h) in got.items() if h} == {0: [(100, "mention", 2, 5)], 6: [(100, "mention", 1, 4)]}
    assert {d for d, (f, _) in got.items() if f} == {2, 7}
    assert {r["doc_id"] for r in decontaminate.clean(docs, bench).collect()} == {0, 1, 3, 4, 5, 6}


def test_a_copy_of_some_length_with_an_edited_value_is_a_hint(spark):
    item = "The red barn holds 7 cows and " + " ".join(f"word{i}" for i in range(8)) + " while 7 goats"
    edited = item.replace("while 7", "while 9")
    got, _, _ = hints(spark, [edited, f"{edited} . {item}", item.replace("7", "9"), "The red barn holds 7 cows"], [item])
    assert {d: len(f) for d, (f, _) in got.items()} == {0: 0, 1: 1, 2: 1, 3: 0}
    assert [x["kind"] for x in got[0][1]] == ["edited"]
    assert decontaminate.COVER <= got[0][1][0]["n_words"] < decontaminate.VERBATIM
    assert not got[1][1] and not got[2][1] and not got[3][1]


def test_items_that_share_a_window_are_all_named(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PAIRS", 10)
    stem = "what is the capital of the land that lies to the north of the river"
    items = [f"{stem} x{i}" for i in range(40)]
    table = decontaminate.Templates(list(range(40)), items)
    raw, offsets = decontaminate.K.string_parts(decontaminate.pa.array([f"so {stem} x7 here", "nothing of the kind", f"{stem} x8"]))
    got = table.search(raw, offsets)
    assert {d: len(v) for d, v in got.items()} == {0: 40, 2: 40}
    assert {x["item_id"]: x["n_words"] for x in got[0]}[7] == 16


def test_clash_repeated_rows_long_text_and_empty_table(spark):
    item = "The quick old farmer sells nine of his brown hens on the market in the town."
    docs = spark.createDataFrame([(1, item, "x"), (1, item, "x"), (2, "word " * 300_000 + item, "y"), (None, None, None)], "doc_id long, text string, found string")
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    out = decontaminate.find(docs, bench, ["doc_id", "found"])
    assert out.columns == ["doc_id", "found"]
    assert sorted((str(r["doc_id"]), len(r["found"])) for r in out.collect()) == [("1", 1), ("1", 1), ("2", 1), ("None", 0)]
    assert decontaminate.clean(docs, bench).columns == docs.columns
    assert decontaminate.find(docs.limit(0), bench, ["doc_id"]).count() == 0
