import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldnotes.llm import pii
from tests.llm.conftest import words

# the patterns as they are asked for, without the linear forms of the operator
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(s):
    return sum(v if v < 10 else v - 9 for i, c in enumerate(reversed(s)) for v in [int(c) * (2 if i % 2 else 1)]) % 10 == 0


def plain(text):
    only = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 16 <= len(only(m)) <= 19 and luhn(only(m))]
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(only(m)) <= 15]


PIECES = ["a.b@c.de", "@", "x@y", "a@b.c@d.e", ".", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "0001.02.3.4", "4111111111111111",
          "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (456) 555-2186", "+", "+1", "+49.30.1234567", " ", "-", "x", "é", "7",
          "(", ")", "1234567890123456789012", "a@-.-", "%@a.b", "\n", "+4111111111111111"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_base_like_the_plain_patterns(text):
    assert pii.base_spans(text) == plain(text)


def test_long_runs_stay_linear():
    for text in ("a" * 300_000 + "@", "a" * 300_000 + "@b.c", "1" * 300_000, "1." * 100_000, "@a.b" * 60_000, "+1" * 60_000):
        assert pii.base_spans(text) is not None
    assert pii.base_spans("a" * 300_000 + "@b.c") == [(0, 0, 300_004)]


def luhn_card(rng):
    d = [4, *rng.integers(0, 10, 14)]
    s = "".join(map(str, d))
    return next(s + c for c in "0123456789" if luhn(s + c))


def private(rng):
    n = rng.integers(10, 99, 4)
    return [f"user{n[0]}.{n[1]}@mail{n[2]}.example.com", ".".join(map(str, n)), luhn_card(rng),
            f"+1 ({n[0]}5) 555-{n[1]}{n[2]}"][int(rng.integers(0, 4))]


def corpus(n=250, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        w = words(rng, int(rng.integers(5, 150))).split()
        if i % 2 == 0:
            for _ in range(int(rng.integers(1, 4))):
                w.insert(int(rng.integers(0, len(w))), private(rng))
        elif i % 3 == 0:
            w.insert(1, f"Version {i}.0. Licence 4.0, token=ab{i}cd9e, page {i}")
        rows.append((i, " ".join(w)))
    return rows


def test_query_columns_and_odd_rows(make):
    rows = corpus() + [(900, None), (901, ""), (902, "a 1 " * 60_000), (903, "x@y.zz"), (0, corpus()[0][1])]
    docs = make(rows)
    got = pii.find(docs, pii.train(docs)).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    for r in got:
        base = plain(text[r["doc_id"]] or "")
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(b[0] == k for b in base) for k in range(4)]
        written = [f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert set(written) <= set(r["spans"].split(","))


def test_the_tagger_learns(make):
    docs = make(corpus(400))
    tagger = pii.train(docs)
    rng = np.random.default_rng(77)
    found = clean = wrong = 0
    for _ in range(120):
        w = words(rng, 60).split()
        n = rng.integers(100, 999, 3)
        phone = f"({n[0]}) {n[1]}-{n[2]}{n[0] % 10}"
        w.insert(30, phone)
        text = " ".join(w)
        spans = pii.tag_texts(tagger, [text])[0][1]
        at = text.index(phone)
        found += any(k == 3 and s <= at + 1 and e >= at + len(phone) - 1 for k, s, e in spans)
        plain_text = " ".join(words(rng, 60).split()[:30] + ["page", "12", "of", "2024", "Version", "2.0."])
        base, spans = pii.tag_texts(tagger, [plain_text])[0]
        clean += 1
        wrong += spans != base
    assert found >= 100 and wrong <= 3


def test_gradient_is_right():
    rng = np.random.default_rng(0)
    tagger = pii.Tagger.new(3)
    ids = rng.integers(0, pii.CLASSES, (3, 7))
    tags = rng.integers(0, pii.TAGS, (3, 7))
    _, grad = tagger.loss(ids, tags)
    for name, g in grad.items():
        for at in list(np.ndindex(g.shape))[:: max(1, g.size // 5)]:
            keep = tagger.w[name][at]
            if name == "embed" and at[0] not in ids:
                continue
            tagger.w[name][at] = keep + 1e-5
            up = tagger.loss(ids, tags)[0]
            tagger.w[name][at] = keep - 1e-5
            down = tagger.loss(ids, tags)[0]
            tagger.w[name][at] = keep
            assert abs((up - down) / 2e-5 - g[at]) < 1e-4 * max(1, abs(g[at]))


def test_decoding_like_brute_force():
    import itertools
    rng = np.random.default_rng(1)
    tagger = pii.Tagger.new(4)
    tagger.w["step"] = rng.normal(0, 1, tagger.w["step"].shape)
    ids = rng.integers(0, pii.CLASSES, (2, 4))
    e, _ = tagger.emissions(ids)
    got = tagger.decode(ids)
    for b in range(2):
        score = lambda y: tagger.w["first"][y[0]] + sum(e[t, b, y[t]] for t in range(4)) + sum(
            tagger.w["step"][y[t - 1], y[t]] for t in range(1, 4))
        best = max(itertools.product(range(pii.TAGS), repeat=4), key=score)
        assert tuple(got[b]) == best


def test_windows_are_reconciled():
    tags = np.zeros(300, np.int8)
    tags[40] = 1
    tags[41:130] = 2  # one long span over three windows
    tags[200], tags[201:215] = 7, 8
    starts = [0, 48, 96, 144, 192, 240]
    pad = np.concatenate([tags, np.zeros(96, np.int8)])
    spans = pii.reconciled(300, [(s, pad[s:s + 96]) for s in starts])
    assert spans == [(0, 40, 130), (3, 200, 215)]


def test_masking(make):
    rows = [(1, "mail a.b@c.de or +1 (456) 555-2186 now"), (2, "plain"), (3, None), (4, "")]
    docs = make(rows)
    out = pii.masked_documents(docs, None)
    assert out.columns == docs.columns
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert got[1][0] == "mail <EMAIL> or <PHONE> now" and got[1][1] == len(got[1][0])
    assert got[2] == ("plain", 5) and got[3] == (None, None) and got[4] == ("", 0)
    assert pii.mask("0123456789", [(1, 2, 5), (2, 4, 7)]) == "01<IP>789"


def test_empty_table(make):
    assert pii.train(make([])) is None
    assert pii.find(make([]), None).collect() == []


def test_neighbours_are_told_apart(make):
    tagger = pii.train(make(corpus(400)))
    rng = np.random.default_rng(78)
    one, two = luhn_card(rng), luhn_card(rng)
    four = " ".join(two[i:i + 4] for i in range(0, 16, 4))
    for parts in ([(2, one), (2, one)], [(2, one), (2, two)], [(2, one), (2, two), (2, one)], [(2, one), (2, four)],
                  [(3, "+1 (826) 555-4081"), (1, "190.137.223.204")], [(3, "+1 (826) 555-4081"), (2, one)],
                  [(2, one), (1, "190.137.223.204")], [(-1, "12"), (2, one)], [(2, one), (-1, "2024")]):
        before = words(rng, 12) + " "
        text, want = before, []
        for kind, form in parts:
            if kind >= 0:
                want.append((kind, len(text), len(text) + len(form)))
            text += form + " "
        text += words(rng, 12)
        base, spans = pii.tag_texts(tagger, [text])[0]
        assert base == plain(text)
        assert spans == sorted(want), text[len(before):]


def test_decoded_spans_are_trimmed_and_divided():
    rng = np.random.default_rng(79)
    one, two = luhn_card(rng), luhn_card(rng)
    text = f"{one},{two} or (826) 555-4081 190.137.223.204 or +1 (826) 555-4081"
    base = pii.base_spans(text)
    at = text.index("(826)")
    assert pii.added_spans(text, base, [(3, at, text.index(" or +1"))]) == [(3, at, at + 14)]
    text = f"x {one}/{two}"
    assert pii.added_spans(text, [], [(2, 5, len(text) - 3)]) == [(2, 2, 18), (2, 19, 35)]
    for text in ("1 " * 100_000, "1234 " * 60_000, "+1 " + "1234 " * 60_000, "1" * 300_000, "4111111111111111 " * 20_000):
        assert pii.added_spans(text, pii.base_spans(text), [(2, 0, len(text))]) is not None
    assert len(pii.added_spans(text, [], [])) == 20_000
