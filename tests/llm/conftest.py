import pytest

from rowtide.llm.common import prepare

SCHEMA = (
    "doc_id long, text string, lang string, source string, node long, n long, fp string, low long, body string, id string, "
    "key int, flag int, judged int, copies int, place int, __dropped int, m map<string,int>"
)

BASE = (
    "the quick brown fox jumps over the lazy dog while seven wizards quietly mix strong potions near a cold river and "
    "count every star above the old stone bridge before the morning bell rings twice across the silent sleeping town "
    "whose lamps still burn in narrow windows facing the grey harbour where tall ships wait for wind and early tide"
)


def near_copy(i: int) -> str:
    words = BASE.split()
    words[i % len(words)] = f"word{i}"
    return " ".join(words)


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def docs(llm):
    """Nulls, empty and long texts, ties, repeated rows, copies, near copies, columns named like internal ones."""
    texts = [None, None, "", " \t", "a", "a", "A", "a b", "...", "Straße über Ärger", BASE, BASE]
    texts += [near_copy(i) for i in range(12)] + [BASE.upper()] + ["x " * 30_000 + str(i) for i in range(2)]
    rows = [(i, t, ("en", None, "de")[i % 3], ("s1", "s2", None, "s1")[i % 4]) for i, t in enumerate(texts)]
    rows += [(4, "a", "en", "s1"), (4, "a", "en", "s1"), (None, "a", None, None), (None, "only null id", "en", "s2")]
    extra = (7, 3, "x", 5, "clash", "clash", 1, 2, 3, 4, 5, 6, {"a": 1})
    return llm.createDataFrame([r + extra for r in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
