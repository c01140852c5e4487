import pytest

from dailybars.llm.common import ship_package

# Extra columns whose names the operators use inside.
CLASHING = "score string, doc string, digest string, row_key string, rank string, features string"
N_EXTRA = 6


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """Documents from (doc_id, text, lang) rows, with clashing columns."""
        data = [(i, t, g, "src", None, *["x"] * N_EXTRA) for i, t, g in rows]
        return spark.createDataFrame(
            data, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}")
    return make


SENTENCES = {
    "en": "the quick brown fox jumps over the lazy dog and then it runs through the old forest",
    "de": "der schnelle braune fuchs springt über den faulen hund und läuft durch den alten wald",
    "fr": "le renard brun saute par dessus le chien paresseux et court dans la vieille forêt",
}


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang): a few dozen documents with copies and odd rows."""
    rows, n = [], 0
    for lang, text in SENTENCES.items():
        words = text.split()
        for k in range(10):
            rows.append((n, " ".join(words[k % 5:] + words[:k % 5] + [f"wort{n}"] * (k % 3)), lang))
            n += 1
    rows += [(n, None, "en"), (n + 1, "", "de"), (n + 2, " \t\r\n", None), (n + 3, "123 !? 45", "fr"),
             (n + 4, "the the the " * 4000, "en"), (n + 5, rows[3][1], "en"), (n + 6, rows[3][1], "en"),
             (n + 6, rows[3][1], "en"), (None, rows[3][1], "en"), (None, "no id here at all", None)]
    return rows
