"""Every query of the corpus operators, and the pipeline, on tables whose parts
hold only nulls, only blanks, only a letter, or only texts without a repeat."""

import pytest

import __spark_entry__ as entry
from tempograin.llm import queries

PARTS = {
    "nulls": [None] * 40,
    "blanks": ["", " ", "\n", " \t\n "] * 5,
    "letters": ["a", "b", None, "é"],
    "apart": [" ".join(f"w{i}x{j}" for j in range(40)) + f"\nand line {i}" for i in range(8)],
    "equal": ["six equal short texts"] * 6,
}
NAMES = [*queries.queries(), "pipeline"]


def tables(spark, folder, parts):
    number = 0
    for texts in parts:
        rows = [(number + i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else "s", len(t or "")) for i, t in enumerate(texts)]
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.mode("append").parquet(f"{folder}/documents.parquet")
        number += len(texts)
    spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(number)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([("a", "a"), ("b", None)], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(1, None, None), (2, "", ""), (3, "a", None)], "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    return str(folder), number


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    kinds = {"nulls": [PARTS["nulls"][:5]], "parts": list(PARTS.values()), "one": [["a text of its own"]]}
    return {kind: tables(spark, tmp_path_factory.mktemp(kind), parts) for kind, parts in kinds.items()}


@pytest.mark.parametrize("kind", ["nulls", "parts", "one"])
@pytest.mark.parametrize("name", NAMES)
def test_ends(spark, folders, name, kind):
    folder, number = folders[kind]
    rows = entry.queries()[name](spark, folder).collect()
    if name == "op5_url_filter":
        assert len(rows) == 3
    elif name not in ("pipeline", "op11_source_divergence", "op4_paragraphs", "op4_passages"):
        assert len(rows) == number
