"""Periodic runs, spelling variants and personal data against plain Python."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from fuelscope.llm import periods, pii, queries, spelling

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, runs string, spans string, word string, n int, h int"


def planted(doc_id, parts):
    """The words that the query of periodic runs judges."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(parts), h // 10
    if h % 10 or not n:
        return parts
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [parts[a + (i - a) % p] if i >= a else parts[i] for i in range(n)]


def all_runs(w):
    out = set()
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            if j > i and size >= max(6, 4 * q) and not any(all(w[k] == w[k + d] for k in range(i, i + size - d)) for d in range(1, q)):
                out.add((i, size, q))
            i = max(j, i + 1)
    return sorted(out)


def drawn(rng):
    k = rng.choice([1, 2, 2, 3, 4])
    around = [[rng.randint(1, k) for _ in range(rng.randint(0, 9))] for _ in range(2)]
    block = [rng.randint(1, k) for _ in range(rng.randint(1, 7))]
    return around[0] + (block * 20)[: rng.randint(0, 40)] + around[1]


def test_runs_of_words_equal_all_pairs():
    rng = random.Random(1)
    for _ in range(1500):
        w = drawn(rng)
        assert periods.runs_of(w) == all_runs(w)


def test_stretches_lose_no_run():
    rng = random.Random(2)
    for _ in range(300):
        texts = [drawn(rng) for _ in range(3)]
        begins = np.cumsum([0] + [len(t) for t in texts])
        flat = [x for t in texts for x in t]
        found = []
        for a, b in periods.stretches(np.array(flat, np.uint64), begins):
            assert any(x <= a and b <= y for x, y in zip(begins, begins[1:]))
            found += [(s + a, n, q) for s, n, q in periods.runs_of(flat[a:b])]
        assert found == [(s + x, n, q) for x, t in zip(begins.tolist(), texts) for s, n, q in all_runs(t)]


def test_extensions_and_minima():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 1000, 500)
    least = periods.RangeMinimum(values)
    lo, hi = np.sort(rng.integers(0, 500, (2, 3000)), axis=0)
    assert least(lo, hi).tolist() == [values[a : b + 1].min() for a, b in zip(lo, hi)]
    w = rng.integers(1, 3, 200).tolist()
    i, j = rng.integers(0, 201, (2, 2000))
    i, j = i[i != j], j[i != j]
    got = periods.Extensions(w)(i, j)
    for a, b, n in zip(i.tolist(), j.tolist(), got.tolist()):
        k = 0
        while max(a, b) + k < 200 and w[a + k] == w[b + k]:
            k += 1
        assert n == k


def test_long_period_in_linear_time():
    rng = random.Random(4)
    block = [rng.randint(1, 9000) for _ in range(9000)]
    began = time.time()
    assert periods.runs_of((block * 7)[:60000]) == [(0, 60000, 9000)]
    assert periods.runs_of([1] * 60000) == [(0, 60000, 1)]
    assert time.time() - began < 30


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(5)
    out = ["", None, "  \n ", "a", "x y " * 40, "a a a a a a", "b a a a a a a b", "one\x0btwo\xa0three " * 9, "ab " * 200000]
    out += [" ".join(str(x) for x in drawn(rng)) for _ in range(80)]
    out += [" ".join(f"w{rng.randint(0, 300)}" for _ in range(rng.randint(1, 200))) for _ in range(60)]
    rows = [(i, t, "r", "s", None, 1, 2) for i, t in enumerate(out)]
    return rows + [rows[4], rows[4], (None, "c d " * 9, None, None, None, None, None), (None,) * 7]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(texts, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def folder(docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    docs.select("doc_id", "text").write.parquet(f"{path}/documents.parquet")
    return path


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def test_periods_query(spark, texts, folder):
    want = []
    for doc_id, text, *_ in texts:
        w = planted(doc_id, WORD.findall(text or ""))
        runs = [(0, len(w), 1)] if len(w) > 10**5 else all_runs(w)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2], sha(listed), sha(kept)))
    got = [tuple(r) for r in queries.QUERIES["op13_periods"](spark, folder).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_periods_of_awkward_tables(docs, empty):
    assert periods.periodic_runs(empty).count() == 0
    got = periods.periodic_runs(docs)
    assert got.columns == ["doc_id", "runs", "collapsed"] and got.count() == docs.count()
    by = {r.doc_id: r for r in got.collect() if r.doc_id is not None}
    assert by[1].collapsed == by[2].collapsed == "" and by[1].runs == []
    assert by[8].collapsed == "ab" and [tuple(x) for x in by[8].runs] == [(0, 200000, 1)]


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def forms(counts):
    near = {w: [x for x in counts if x != w and one_edit(w, x)] for w in counts}
    best = {w: min(near[w], key=lambda x: (-counts[x], x), default=None) for w in counts}
    form = {w: b if b and counts[b] >= 5 * counts[w] else None for w, b in best.items()}
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], form[w] and counts[form[w]], root))
    return out


def some_words(seed, n, letters="abcé", low=6, high=9):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.randint(low, high))): rng.choice([5, 6, 7, 30, 31, 160, 900]) for _ in range(n)}


@pytest.mark.parametrize("cell", [7, 40, 8192])
def test_variants_equal_all_pairs(spark, cell):
    # Cells of seven words: many cells, and several blocks where all counts are equal.
    counts = some_words(1, 500) | {"aaabbb": 5, "ababab": 30, "bbbaaa": 160, "é" * 300: 9, "é" * 299: 50, "é" * 298 + "è": 300, "𝒳bcdef": 6, "xbcdef": 40}
    table = spark.createDataFrame([(w, n, "clash") for w, n in counts.items()], "word string, n long, cell string")
    got = [tuple(r) for r in spelling.variant_forms(table, sample=200, cell=cell).select("word", "n", "n_near", "form", "form_n", "root").collect()]
    assert sorted(got, key=str) == sorted(forms(counts), key=str)


def test_variants_of_awkward_tables(spark):
    schema = "word string, n long"
    assert spelling.variant_forms(spark.createDataFrame([], schema)).count() == 0
    odd = spark.createDataFrame([(None, 5), ("", 6), ("abcdef", None), ("abcdef", 3), ("abcdef", 4), ("abcdeg", 35)], schema)
    assert sorted(map(tuple, spelling.variant_forms(odd).collect())) == [("abcdef", 7, 1, "abcdeg", 35, "abcdeg"), ("abcdeg", 35, 1, None, None, "abcdeg")]


def test_trees_prune():
    words = [w for w in some_words(2, 9000, "abcdefghijklmnop", 8, 8)]
    q, s, seen = spelling.near_in_block(words, words, 8, False)
    assert seen < 0.25 * len(words) ** 2 and len(q) == len(s) and all(one_edit(words[a], words[b]) for a, b in zip(q[:200], s[:200]))


def test_spelling_query(spark, tmp_path):
    rng = random.Random(6)
    pool = list(some_words(3, 40))
    rows = [(i if i else None, " ".join(rng.choice(pool).upper() if k % 9 == 0 else rng.choice(pool) for k in range(60)) + "×÷À-ab1cd") for i in range(400)] + [(401, None), (402, ""), (403, "ab" * 30000)]
    rows += [rows[7]]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    low, counts = {i: i + 32 for i in range(65, 91)}, Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    want = forms({w: n for w, n in counts.items() if len(w) >= 6 and n >= 5})
    got = queries.QUERIES["op11_spelling"](spark, str(tmp_path)).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and any(w[3] for w in want)


def plain_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for kind, pattern, least, most in ((2, r"[0-9]([\x20-]?[0-9])+", 12, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            total = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(d[::-1]))
            if least <= len(d) <= most and (kind == 3 or total % 10 == 0):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(7)
    for alphabet in ("ab.@@1234567890.-  +()%é", "1.23 -+()", "a.@b-", "0123456789 -"):
        for _ in range(5000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
            assert pii.base_spans(text) == plain_spans(text)


def test_base_spans_in_linear_time():
    began = time.time()
    for text in ("7" * 10**6, "a" * 10**6, "1." * 500000, "a@" * 300000, "+1 " * 300000, "a.b@" * 300000):
        pii.base_spans(text)
    assert time.time() - began < 20


def test_gradients_of_the_tagger():
    rng = np.random.default_rng(8)
    net = pii.Tagger(hidden=3)
    for k in ("next", "first"):
        net.p[k] = rng.standard_normal(net.p[k].shape) * 0.3
    x = rng.integers(0, 20, (4, 7))
    y = np.array([[0, 1, 2, 2, 0, 0, 3], [2, 0, 0, 5, 6, 6, 0], [0] * 7, [7, 8, 0, 1, 2, 3, 4]])
    _, grad = net.gradients(x, y)
    for k, g in grad.items():
        for at in rng.integers(0, g.size, 6):
            value = net.p[k].flat[at]
            ends = []
            for step in (1e-5, -1e-5):
                net.p[k].flat[at] = value + step
                ends.append(net.gradients(x, y)[0])
            net.p[k].flat[at] = value
            assert g.flat[at] == pytest.approx((ends[0] - ends[1]) / 2e-5, abs=1e-7)


def test_marginals_and_best_path_equal_all_paths():
    import itertools

    rng = np.random.default_rng(9)
    net = pii.Tagger(hidden=2)
    net.p["next"], net.p["first"] = rng.standard_normal((9, 9)), rng.standard_normal(9)
    e = rng.standard_normal((4, 1, 9))
    A, total, by = net.p["next"] + pii._BARRED, 0.0, np.zeros((4, 9))
    for path in itertools.product(range(9), repeat=4):
        w = np.exp(net.p["first"][path[0]] + sum(e[t, 0, k] for t, k in enumerate(path)) + sum(A[a, b] for a, b in zip(path, path[1:])))
        total += w
        for t, k in enumerate(path):
            by[t, k] += w
    m, _, z = net.marginals(e)
    assert np.allclose(m[:, 0], by / total) and z[0] == pytest.approx(np.log(total))
    for _ in range(30):
        mean = rng.dirichlet(np.full(9, 0.3), 5)
        tags, sure = pii.reconciled([np.concatenate([mean, np.full((pii.WINDOW - 5, 9), 1 / 9)])], [0], 0, 5)
        allowed = [p for p in itertools.product(range(9), repeat=5) if (p[0] == 0 or p[0] % 2) and all(pii._BARRED[a, b] == 0 for a, b in zip(p, p[1:]))]
        best = max(allowed, key=lambda p: sum(np.log(max(mean[t, k], 1e-12)) for t, k in enumerate(p)))
        assert tuple(tags) == best and np.allclose(sure, mean[np.arange(5), tags])


@pytest.fixture(scope="module")
def net(spark):
    return pii.trained(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_tagger_on_texts_it_has_not_seen(spark):
    """Alone, without the patterns, it finds nearly all base spans of other documents."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    net = pii.trained(docs.where("doc_id % 2 = 0"))
    seen = {t for t, _ in pii.training_stretches(docs.where("doc_id % 2 = 0"))}
    fresh = [s for s in pii.training_stretches(docs.where("doc_id % 2 = 1")) if s[0] not in seen and s[1]]
    hit, total = Counter(), Counter()
    for text, spans in fresh:
        starts = pii.window_starts(0, len(text))
        x = np.zeros(starts[-1] + pii.WINDOW + pii.STRIDE, np.int64)
        x[pii.STRIDE : pii.STRIDE + len(text)] = pii.symbols(text)
        m = net.window_marginals(np.array([x[s + pii.STRIDE : s + pii.STRIDE + pii.WINDOW] for s in starts]))
        found = {s[:3] for s in pii.tagged(text, pii.reconciled(m, starts, 0, len(text))[0], 0)}
        total.update(k for _, k, _ in spans)
        hit.update(k for a, k, b in spans if (a, k, b) in found)
    print(hit, total)
    assert min(total.values()) > 20 and sum(hit.values()) >= 0.9 * sum(total.values())


def test_added_spans(net):
    found = lambda text: [(text[a:b], pii.KINDS[k]) for a, k, b in pii.find_spans([text], net)[0][1]]
    caught = [
        ("mail me at john.smith (at) example.com today", "email"),
        ("server 92[.]165[.]36[.]145 is down", "ip"),
        ("the card 4159.4823.7246.7051 was used", "card"),
        ("please call (813) 555-2273 now", "phone"),
    ]
    assert sum(any(k == kind for _, k in found(text)) for text, kind in caught) >= 3
    for clean in ("on 2024-01-02 12:30:55 here", "version 1.2.3 of 10,222.50 at 99 %", "Licensed under CC BY-NC 4.0.", "no digit at all", 'token = "0641917ea4e9feb9cda83477b57ac2654884f485"'):
        assert found(clean) == []


def test_added_spans_leave_prose_alone(spark, net):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    found = pii.find_spans([r.text for r in rows], net)
    assert sum(len(a) for b, a in found if not b) <= 2
    assert all(y <= s or e <= x for b, a in found for s, _, e in a for x, _, y in b)


def test_windows_do_not_cut_spans(net):
    """Where a span stands in a stretch, and how long the stretch is, make no difference."""
    texts = ["9 " * k + "and so the words go on server 92[.]165[.]36[.]145 is down and the words go on " + "x 7 " * (40 - k) for k in range(0, 40, 3)]
    spans = [[t[s:e] for s, k, e in a if k == 1] for t, (_, a) in zip(texts, pii.find_spans(texts, net))]
    assert sum(s == ["92[.]165[.]36[.]145"] for s in spans) >= 0.9 * len(spans)


def test_pii_query(spark, tmp_path):
    texts = [None, "", "é a.b@c.de, 10.0.0.1 and +1 (555) 555-0100", "4111 1111 1111 1111", "x" * 10**6 + " a@b.cc", "7" * 10**5, "plain words only"] + [f"call +44 20 7946 0{k:03} or mail u{k}@host{k}.org" for k in range(40)]
    rows = [(i, t, "clash", "clash") for i, t in enumerate(texts)] + [(2, texts[2], None, None), (None, texts[3], None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, base string, spans string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op12_pii"](spark, str(tmp_path)).collect()
    want = []
    for i, t, *_ in rows:
        base = plain_spans(t or "") if t is None or len(t) < 10**4 else [(10**6 + 1, 0, 10**6 + 7)] if "@" in t else []
        count = Counter(k for _, k, _ in base)
        want.append((i, *(count[k] for k in range(4)), sha(",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base))))
    assert sorted((str((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256)) for r in got)) == sorted(map(str, want))
    for r in got:
        spans = [s.split(":") for s in r.spans.split(",") if s]
        order = [(int(s), pii.KINDS.index(k), int(e)) for k, s, e in spans]
        assert order == sorted(order) and len(spans) == r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_added


def test_pii_of_awkward_tables(docs, empty):
    assert pii.personal_data(empty).count() == 0
    got = pii.personal_data(docs)
    assert got.columns == ["doc_id", "base", "added"] and got.count() == docs.count()
    # No labelled span to learn from: the patterns alone.
    assert pii.trained(docs.where("doc_id < 9")) is None
    assert all(not r.base and not r.added for r in pii.personal_data(docs.where("doc_id < 9")).collect())
