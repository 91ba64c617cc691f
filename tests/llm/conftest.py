import pytest

from fieldnotes.llm.common import prepare

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: columns whose names the operators use inside
CLASH = ", size bigint, hash string, score string, lang_pred string, node string, rank int, length string, chars string"
CLASHING = (7, "h", "s", "l", "n", 1, "x", "c")


@pytest.fixture(autouse=True)
def _workers(spark):
    prepare(spark)


@pytest.fixture()
def make(spark):
    """documents from (doc_id, text[, lang[, source]]), with extra columns
    whose names clash; spread over a few partitions."""
    def build(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 None if r[1] is None else len(r[1]), *CLASHING) for r in rows]
        return spark.createDataFrame(full, DOCS + CLASH).repartition(parts)
    return build


def words(rng, n, vocabulary=400):
    """A text of n invented words."""
    syllables = ["ka", "lo", "mi", "ren", "tu", "ves", "or", "an", "dis", "pe"]
    return " ".join("".join(syllables[int(d)] for d in str(x)) for x in rng.integers(0, vocabulary * 25, n))
