"""Items that a document holds letter for letter, or in another case, are found whatever their words look like."""

from tests.llm._rows import documents
from wordloom.llm.decontamination import clean, contaminated


def test_verbatim_items(spark):
    names = "Anna Peter Maria 12 Bonn 14 Berlin Hamburg 7 Paul Emma Oslo 99 Rom Wien"
    passage = "on the way home the two friends met young Clara who had lost her keys near the old bridge again"
    short = "Der Rhein Fließt"
    bench = spark.createDataFrame([(1, names), (2, passage), (3, short), (4, None)], "item_id long, text string")
    rows = [
        (1, f"some words before {names} and some after"), (2, f"it says {passage.lower()} and so on"), (3, passage.upper()), (4, f"heute sagt er: {short}"),
        (5, " ".join(names.split()[:8]) + " and then other words that no item holds"), (6, " ".join(reversed(passage.split()))), (7, None), (8, "der Rhein"),
    ]
    docs = documents(spark, rows).repartition(3)
    assert {r["doc_id"]: r["item_ids"] for r in contaminated(docs, bench).collect()} == {1: [1], 2: [2], 3: [2], 4: [3]}
    assert {r["doc_id"] for r in clean(docs, bench).collect()} == {5, 6, 7, 8}
