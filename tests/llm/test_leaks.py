from __future__ import annotations

from tests.llm.test_filters import found


def kinds(got):
    return {d: [(x["item_id"], x["kind"]) for x in v] for d, v in got.items()}


def test_verbatim_copies_of_numbers_are_found(spark):
    items = ["Compute 12 + 7 - 3 = 16, 5 * 8 = 40, 9 * 6 = 54 and 81 / 9 = 9", "Add 17 to 25 quickly"]
    texts = [f"Before that. {items[0]} and after.", f"so {items[1]} now", items[0].replace("16", "17"), "12 7 3 16 5 8 41 9 6 54", items[1].replace("17", "18")]
    got, _, _ = found(spark, texts, items)
    assert kinds(got) == {0: [(100, "verbatim")], 1: [(101, "verbatim")], 2: [], 3: [], 4: []}


def test_literal_windows_take_no_finding_away(spark):
    head = "The old farmer keeps 12 brown hens and sells all of their eggs on the market for"
    item = head + " 1 2 3 4 5 6 7 12"
    got, _, _ = found(spark, [head.replace("12", "40") + " 1 2 3 4 5 6 7 12"], [item])
    assert kinds(got) == {0: [(100, "reparameterised")]}


def test_names_that_begin_sentences(spark):
    items = ["Tom has 3 apples. Tom buys 4 pears. Tom eats 2 of the plums. Tom sells 5 nuts.", "Maria paints 6 big doors in 3 days."]
    texts = [items[0].replace("Tom", "Anna").replace("3", "9"), items[1].replace("Maria", "José"), "Anna".join(items[0].split("Tom")[:2]) + "Tom" + "Anna".join(items[0].split("Tom")[2:4]) + "Tom" + items[0].split("Tom")[4], "The boy has 3 apples."]
    got, _, _ = found(spark, texts, items)
    assert kinds(got) == {0: [(100, "reparameterised")], 1: [(101, "reparameterised")], 2: [], 3: []}
    assert (got[0][0]["from_word"], got[0][0]["to_word"], got[0][0]["n_words"]) == (0, 18, 18)


def test_runs_of_placeholders_and_attached_units(spark):
    items = ["A train leaves from Boston with 30 people and brings them all to Chicago after lunch", "A bag of 5kg rice costs as much as the 3rd box on the shelf"]
    texts = [
        "x y z " + items[0].replace("Boston", "New York").replace("30", "twenty five"),
        items[1].replace("5kg", "9 pounds"),
        items[1].replace("5kg", "9kg").replace("3rd", "4th"),
    ]
    got, _, _ = found(spark, texts, items)
    assert kinds(got) == {0: [(100, "reparameterised")], 1: [(101, "reparameterised")], 2: [(101, "reparameterised")]}
    assert (got[0][0]["from_word"], got[0][0]["to_word"]) == (3, 21)
