from collections import defaultdict

import duckdb
import numpy as np
import pytest

from fieldnotes.llm import mixing
from fieldnotes.llm.queries import OP7_SQL
from tests.llm.conftest import words


def rows_of(n=300, seed=1):
    rng = np.random.default_rng(seed)
    sources = ["b", "a", None, "zé", "ä"]
    return [(i, words(rng, int(rng.integers(1, 30))), "en", sources[int(rng.integers(0, 5)) if i % 3 else 0])
            for i in range(n)]


def mixed(make, rows):
    docs = make(rows)
    return mixing.mix(mixing.sized(docs)).collect()


def test_like_sql(make):
    rows = rows_of() + [(1000, None, "en", "a"), (1001, "", "en", None), (1002, " \t\x0b\n", "en", "b"),
                        (1003, "é\x85x\xa0y z", "en", "b")]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(r[0], r[1], r[3]) for r in rows])
    want = {r[0]: r[1:] for r in con.sql(OP7_SQL).fetchall()}
    got = {r["doc_id"]: (r["size"], r["source_size"], r["target"], r["taken"]) for r in mixed(make, rows)}
    assert got == want


def test_targets_and_limits(make):
    got = mixed(make, rows_of(600))
    by = defaultdict(list)
    for r in got:
        by[r["target"]].append(r)
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    total = sum(r["size"] for r in got)
    assert sum(by) == pytest.approx(1.5 * total)
    for target, rs in by.items():
        assert target <= 2 * rs[0]["source_size"]
        assert 0 <= target - sum(r["taken"] for r in rs) <= max(r["size"] for r in rs)


def test_the_same_again_and_in_any_order(make):
    rows = rows_of(200)
    assert sorted(mixed(make, rows)) == sorted(mixed(make, rows[::-1]))


def test_a_key_that_holds_a_third_of_a_source_is_taken_row_by_row(make):
    copies = [(7, "one two three", "en", "a")] * 100 + [(7, "other text of this key", "en", "a")] * 60
    rows = copies + [(i, "w " * (i % 9 + 1), "en", "ab"[i % 2]) for i in range(20, 220)]
    got = mixed(make, rows)
    sources = {}
    for r in got:
        size, taken = sources.setdefault((r["source_size"], r["target"]), [0, 0])
        sources[r["source_size"], r["target"]] = [size + r["size"], taken + r["taken"]]
        assert r["taken"] <= 2 * r["size"]
    assert len(sources) == 2
    for (size, target), (words_of, taken) in sources.items():
        assert size == words_of and 0 <= target - taken <= 9
    assert sorted(got) == sorted(mixed(make, rows[::-1]))
    assert sorted(got) == sorted(mixed(make, rows[50:] + rows[:50]))


def test_repeated_null_keys_in_documents(make):
    docs = make([(None, "one two three", "en", "a")] * 60 + [(i, "w " * 5, "en", "b") for i in range(30)])
    taken = sum(r["taken"] for r in mixing.mix(mixing.sized(docs)).collect())
    out = mixing.mix_documents(docs).collect()
    assert sum(len(r["text"].split()) for r in out) == taken


def test_empty_table_and_no_words(make):
    assert mixed(make, []) == []
    got = mixed(make, [(1, None), (2, "")])
    assert [(r["size"], r["target"], r["taken"]) for r in got] == [(0, 0.0, 0)] * 2


def test_documents_are_repeated_as_taken(make):
    docs = make(rows_of(120))
    taken = {r["doc_id"]: r["taken"] // max(1, r["size"]) for r in mixing.mix(mixing.sized(docs)).collect()}
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    got = defaultdict(int)
    for r in out.collect():
        got[r["doc_id"]] += 1
    assert got == {k: n for k, n in taken.items() if n}


def test_no_python_on_the_main_path(make):
    plan = mixing.mix(mixing.sized(make(rows_of(20))))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
