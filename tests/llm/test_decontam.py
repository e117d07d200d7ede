from __future__ import annotations

from conftest import SF_DIR
from llm_fixtures import _importable, frame, hostile, nothing  # noqa: F401
from pyspark.sql import functions as F

from tallywind.llm import decontam as D
from tallywind.llm.queries import QUERIES

ITEM = "On Monday Alice bought 12 apples for 3 dollars each and then Alice gave 5 apples to her brother before she walked 7 miles home with Bob ."
OTHER = "A river runs slowly past the old stone mill where seven women once washed linen and sang together until the sun went down behind hills ."
FILL = "these words stand around a passage and have nothing to do with what it says at all"


def items(spark):
    rows = [(1, ITEM), (2, OTHER), (3, OTHER.upper()), (4, "too short"), (None, "a null id stands here with quite enough plain words to be sought by windows"), (5, None), (6, "")]
    return spark.createDataFrame(rows, "item_id long, text string")


def held(docs, spark):
    return {(r["doc_id"], r["item_id"]): r for r in D.held_items(docs, items(spark)).collect()}


def test_exact_reparameterised_and_clean(spark, frame):
    changed = ITEM.replace("Alice", "Carol").replace("12", "40").replace("3", "9").replace("5", "6").replace("miles", "km").replace("Monday", "Friday")
    mixed = ITEM.replace("Alice bought", "Carol bought").replace("Alice gave", "Wendy gave").replace("12", "1").replace("Bob", "Ed")
    docs = frame([f"{FILL} {ITEM} {FILL}", f"{FILL}\n{changed}\n{FILL}", f"{FILL} {OTHER[:70]} {FILL}", FILL, f"{FILL} {OTHER.upper()}", f"x {OTHER} y {ITEM}", mixed])
    got = held(docs, spark)
    assert set(got) == {(0, 1), (1, 1), (4, 2), (5, 1), (5, 2), (6, 1)}
    assert got[(0, 1)]["slots_changed"] == 0 and got[(0, 1)]["slots"] > 4
    assert got[(1, 1)]["slots_changed"] >= 5 and got[(1, 1)]["slots_consistent"] == got[(1, 1)]["slots"]
    assert got[(6, 1)]["slots_consistent"] == got[(6, 1)]["slots"] - 1  # Alice became two people


def test_slots_that_disagree_are_no_match(spark, frame):
    item = "the 1 and the 1 with the 1 near the 1 over the 1 under the 1 beside the 1 past the 1 end"
    one = spark.createDataFrame([(1, item)], "item_id long, text string")
    agreed = item.replace("1", "8")
    torn = item
    for i in range(2, 10):
        torn = torn.replace(" 1 ", f" {i} ", 1)
    got = D.held_items(frame([agreed, torn]), one).collect()
    assert [r["doc_id"] for r in got] == [0]


def test_every_planted_item_is_found(spark):
    folder = SF_DIR.replace("0.001", "0.01")
    docs, bench = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    want = {(r["doc_id"], r["item_id"]) for r in docs.join(bench.withColumnRenamed("text", "item"), F.contains("text", F.col("item"))).select("doc_id", "item_id").collect()}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op8_benchmark_decontamination"](spark, folder).collect()}
    assert want <= got and len(got - want) <= 2


def test_windows_by_hand(spark, frame):
    """The windows of a text are those of its words one by one."""
    text = "In Rome, Anna paid 20 euros. The 3 big dogs! saw Ben run"
    words = [("in", "p"), ("rome", "n"), ("anna", "n"), ("paid", "p"), ("20", "#"), ("euros", "u"), ("the", "p"), ("3", "#"), ("big", "p"), ("dogs", "p"), ("saw", "p"), ("ben", "n"), ("run", "p")]
    rows = D.template_windows(frame([text]), "doc_id", "text").orderBy("pos").collect()
    enough = [i for i in range(len(words) - 7) if sum(k == "p" for _, k in words[i : i + 8]) >= D.PLAIN_WORDS]
    assert [r["pos"] for r in rows] == enough
    kinds = {"#": D.NUMBER, "u": D.UNIT, "n": D.NAME}
    for r in rows:
        assert [s["kind"] for s in r["slots"]] == [kinds[k] for _, k in words[r["pos"] : r["pos"] + 8] if k != "p"]


def test_odd_texts(spark, hostile, nothing):
    bench = items(spark)
    assert D.held_items(hostile, bench).count() == 0
    assert D.held_items(hostile, bench.limit(0)).count() == 0
    assert D.held_items(nothing, bench).count() == 0
    rows = spark.createDataFrame([(None, ITEM, "x"), (None, ITEM, "x"), (7, None, "y"), (8, FILL, "z")], "doc_id long, text string, item_id string")
    assert D.held_items(rows, bench).count() == 2
    assert {r["doc_id"] for r in D.without_items(rows, bench).collect()} == {7, 8}


ACCENTED = "Le soir, Émilie Dupré était allée à Orléans où l'été dernier Zoë Müller avait acheté des pâtes près du château avec Łukasz Śliwa et Ольга Петрова ."


def test_copies_in_other_case(spark, frame):
    """Names are known by capitals, which copies in capitals or small letters have not; accents fold too."""
    bench = spark.createDataFrame([(1, ITEM), (2, ACCENTED)], "item_id long, text string")
    capitals = ITEM.upper().replace("12", "40").replace("7", "8")
    docs = [ACCENTED.upper(), ACCENTED.lower(), ITEM.upper(), ITEM.lower(), capitals, FILL.upper()]
    got = {(r["doc_id"], r["item_id"]): r for r in D.held_items(frame([f"{FILL} {d} {FILL}" for d in docs]), bench).collect()}
    assert set(got) == {(0, 2), (1, 2), (2, 1), (3, 1), (4, 1)}
    assert got[(4, 1)]["slots_changed"] == 2


def test_names_and_numbers_of_other_lengths(spark, frame):
    item = "every week Alice sold 12 red lamps to Bob for 30 coins while Carol paid 9 coins for lamps that Dan kept there"
    changed = item.replace("Alice", "Mary Ann Lee").replace("12", "twenty five").replace("Bob", "Sir John Smith").replace("30", "two hundred")
    changed = changed.replace("Carol", "Eva Maria").replace("9", "thirty-one").replace("Dan", "Uncle Joe")
    got = D.held_items(frame([changed, FILL]), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert [(r["doc_id"], r["slots_consistent"] == r["slots"], r["slots_changed"]) for r in got] == [(0, True, 7)]
