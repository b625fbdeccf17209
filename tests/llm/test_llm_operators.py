"""Operators on a small table with every awkward row, against plain Python."""

import hashlib
import itertools
import math
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fuelscope.llm.tokenize import Encoder
from fuelscope.llm import common, language, lines, mix, near, packing, quality, queries, substrings, tokenfile, topk, toxicity
from fuelscope.session import BATCH_BYTES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, mix string, h int, v int"


def prose(seed, n, words=400):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{i}" for i in rng.integers(0, words, n))


@pytest.fixture(scope="module")
def rows():
    long = prose(1, 300, 10**6)
    near_copy = long.split()
    near_copy[100] = "changed"
    passage = prose(2, 60, 10**6)
    texts = [long, long, " ".join(near_copy), prose(3, 80) + " " + passage + " " + prose(4, 30), passage + "\n" + prose(5, 70), None, "", " \n\t ", "one", "One", "a b c d", "a a a " * 40, "é\xa0ñ 日本 x\x85y", prose(6, 3000), "x" * 50000]
    texts += ["common line here\n" + prose(10 + i, 60) for i in range(12)]
    out = [(i, t, "en" if i % 2 else "fr", ["s0", "s1", None][i % 3], None, "clash", "clash", 1, 2) for i, t in enumerate(texts)]
    return out + [out[0], out[5], (None, prose(7, 90), None, None, 1, None, None, None, None), (None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(t):
    return WORD.findall(t or "")


def test_word_hashes_follow_the_words():
    texts = ["a b", None, "", " b\x0ba ", "x\xa0y z" * 50000]
    h, begins = common.hashed_words(texts)
    assert list(np.diff(begins)) == [len(words(t)) for t in texts]
    assert h[0] == h[3] and h[1] == h[2] and h[0] != h[1]


def test_mix(docs, rows, empty):
    got = mix.mix(docs).select("doc_id", "source", "size", "mix").collect()
    assert len(got) == len(rows) and {r["size"] for r in got} == {"clash", None}
    total, by = sum(len(words(r[1])) for r in rows), defaultdict(int)
    for r in got:
        assert 0 <= r.mix.taken <= 3 * r.mix.size and r.mix.target <= 3 * r.mix.source_size
        by[r.source] += r.mix.taken
    target = {r.source: r.mix.target for r in got}
    assert sum(target.values()) == pytest.approx(total) and sum(by.values()) <= total
    assert mix.mixed(empty).count() == 0 and mix.mixed(docs).columns == docs.columns
    assert sorted(map(str, got)) == sorted(map(str, mix.mix(docs).select("doc_id", "source", "size", "mix").collect()))


def test_mix_of_many_sources_runs_over_ranges(spark, monkeypatch):
    # One hot source of small weight behind many small ones: nearly a slot for each row.
    monkeypatch.setattr(mix, "SLOT_ROWS", 1)
    table = [(i, f"s{0 if i % 3 else i:04}" if i else None, prose(i, 1 + i % 7)) for i in range(900)]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, source varchar, text varchar)")
    con.executemany("insert into documents values (?, ?, ?)", table)
    out = mix.mix(spark.createDataFrame([(i, s, t) for i, s, t in table], "doc_id long, source string, text string"))
    got = out.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")
    plan = got._jdf.queryExecution().toString()
    assert not re.search(r"windowspecdefinition\(slot#\d+L? ASC", plan)
    assert Counter(map(str, map(tuple, got.collect()))) == Counter(map(str, con.execute(mix.OP1_SQL).fetchall()))
    ranges = mix.running(spark.range(1000).withColumn("x", F.col("id") * 2), ["id"], {"before": "x"})
    assert {r.id: r.before for r in ranges.collect()} == {i: i * (i - 1) for i in range(1000)}


def test_repeats(docs, rows, empty):
    count, parts = Counter(), [words(r[1]) for r in rows]
    for w in parts:
        count.update(tuple(w[i : i + 35]) for i in range(len(w) - 34))
    want = []
    for r, w in zip(rows, parts):
        gone = {j for i in range(len(w) - 34) if count[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        want.append((r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    assert sorted(map(str, map(tuple, substrings.remove_repeats(docs).collect()))) == sorted(map(str, want))
    assert sum(w[2] for w in want) > 900 and substrings.remove_repeats(empty).count() == 0


def test_quality(docs, rows, empty):
    got = {r.text: r.quality for r in quality.judge(docs, facts=True).collect()}
    for r in rows:
        q, w = got[r[1]], words(r[1])
        c = Counter(zip(w, w[1:], w[2:]))
        repeated = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        full = [x for x in (r[1] or "").split("\n") if words(x)]
        assert (q.n_words, q.word_chars, q.n_repeat_words, q.n_dup_lines) == (len(w), sum(map(len, w)), len(repeated), len(full) - len(set(full)))
        assert q.base_failed == (len(w) < 50 or 100 * len(repeated) > 50 * len(w))
        assert q.rejected_by is not None or not q.base_failed
    # The order of the rules saves work but never changes the verdict.
    for order in itertools.islice(itertools.permutations(quality.RULES), 0, 120, 29):
        assert {r.text for r in quality.judge(docs, list(order)).where("quality.rejected_by is null").collect()} == {t for t, q in got.items() if q.rejected_by is None}
    assert quality.kept(empty).count() == 0


def test_language_learns_and_marks_texts_without_letters(spark, empty):
    rng = np.random.default_rng(0)
    make = lambda parts: " ".join("".join(rng.choice(parts, 3)) for _ in range(30))
    rows = [(i, make(["the", "ing", "ow"] if i % 2 else ["eau", "ois", "que"]), "en" if i % 2 else "fr") for i in range(120)]
    rows += [(200, None, "en"), (201, "12 34 ...", "en"), (202, "", None), (None, "the ing", None)]
    out = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(rows) and all(by[i].lang_pred == ("en" if i % 2 else "fr") for i in range(120))
    assert [by[i].lang_pred for i in (200, 201, 202)] == ["und"] * 3 and by[200].score == 0
    assert by[7].held_out == (zlib.crc32(b"7") % 5 == 0)
    assert language.identify(empty).count() == 0


def test_network_gradients_match_differences():
    net = language.BiGru(3, hidden=4, seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, label = np.frombuffer(b"abcdeabxyz", np.uint8).reshape(2, 5), np.array([0, 2])
    _, grad = net.gradients(x, label)
    for k in ("out", "recf", "recb", "inf"):
        at = tuple(np.argwhere(np.abs(grad[k]) == np.abs(grad[k]).max())[0])
        old, step = net.p[k][at], 1e-3
        net.p[k][at] = old + step
        up = net.gradients(x, label)[0]
        net.p[k][at] = old - step
        down = net.gradients(x, label)[0]
        net.p[k][at] = old
        assert grad[k][at] == pytest.approx((up - down) / (2 * step), rel=2e-2)


def test_packing(docs, rows, empty):
    out = packing.pack(packing.pieces(docs, capacity=64, with_ids=True), capacity=64).collect()
    enc = packing.encoder(packing.TOKENIZER, False).tokenizer
    want = Counter((r[0], tuple(enc.encode(r[1] or "", add_special_tokens=False).ids + [1])) for r in rows)
    got, bins = defaultdict(list), defaultdict(list)
    for r in out:
        assert r.ids_crc32 == zlib.crc32(bytes(r.ids)) and r.length * 4 == len(r.ids) <= 256
        got[r.doc_id, r.start == 0 and r.piece == 0].append(r)
        bins[r.sequence_id].append(r)
    assert sum(r.length for r in out) == sum(len(ids) * n for (_, ids), n in want.items())
    for b in bins.values():
        at = 0
        for r in sorted(b, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    lengths = np.array([r.length for r in out])
    assert packing.lower_bound(lengths, 64) <= len(bins) <= packing.lower_bound(lengths, 64) + 1
    assert packing.pack(packing.pieces(empty)).count() == 0


def test_bounds_never_exceed_the_best_packing():
    rng = np.random.default_rng(3)
    for _ in range(40):
        lengths = rng.integers(1, 11, 7)
        best = min(_bins(order) for order in itertools.permutations(lengths.tolist()))
        assert packing.lower_bound(lengths, 10) <= best <= len(packing.best_fit(lengths, 10)[2])


def test_every_cut_bounds_large_inputs():
    rng = np.random.default_rng(4)
    lengths = np.concatenate([rng.integers(2600, 3400, 6000), rng.integers(900, 1600, 6000), rng.integers(1, 300, 4000)])
    want = 0
    for cut in range(1, 2049):
        v = np.where(lengths > 4096 - cut, 4096, np.where(lengths >= cut, lengths, 0))
        want = max(want, -(-int(v.sum()) // 4096))
    cuts = np.unique(np.minimum(lengths, 4096 - lengths))
    few = max(-(-int(np.where(lengths > 4096 - cut, 4096, np.where(lengths >= cut, lengths, 0)).sum()) // 4096) for cut in cuts[:64])
    assert packing.lower_bound(lengths, 4096) >= want > few
    assert want <= len(packing.best_fit(lengths, 4096)[2])


def _bins(order, capacity=10):
    n, left = 0, 0
    for x in order:
        if x > left:
            n, left = n + 1, capacity
        left -= x
    return n


def test_hidden_words_are_restored(spark):
    clean = "you are an idiot and a stupid moron the loser is here " * 3
    model = toxicity.language_model(spark.createDataFrame([(clean,)] * 5, "text string"))
    reader = toxicity.Reader(model)
    for hidden, plain in (("1d10t", "idiot"), ("st.u.p.i.d", "stupid"), ("m0r0n", "moron"), ("l00oser", "loser"), ("hello", "hello")):
        assert reader.word(hidden.encode()) == plain
    vocabulary, which, _ = reader(["an i d i o t here"])
    assert "idiot" in [vocabulary[i] for i in which]


def test_every_form_of_hiding_is_decoded(spark):
    clean = "you are an idiot and a stupid moron the loser is here an ass will kill shit stop die " * 3
    reader = toxicity.Reader(toxicity.language_model(spark.createDataFrame([(clean,)] * 5, "text string")))
    for hidden, plain in (("a$$", "ass"), ("@$$", "ass"), ("idi07", "idiot"), ("5h17", "shit"), ("d13", "die"), ("k111", "kill"), ("l.0.0.o.ser", "loser"), ("stupiid", "stupid"), ("idiot!!", "idiot"), ("stupid$$$", "stupid"), ("(stupid)", "stupid"), ("|", "")):
        assert reader.word(hidden.encode()) == plain, hidden
    for text, plain in (("you 1 d 1 0 t here", "idiot"), ("s t 0 p it", "stop"), ("so $ h 1 t", "shit")):
        vocabulary, which, _ = reader([text])
        assert plain in [vocabulary[i] for i in which], text


def test_long_hidden_words_and_spaced_runs_are_decoded_whole(spark):
    clean = "you are an idiot and a stupid moron the loser is here " * 3
    reader = toxicity.Reader(toxicity.language_model(spark.createDataFrame([(clean,)] * 5, "text string")))
    assert reader.word(b"st" + b"u" * 40 + b"pid") == "stupid"
    assert reader.word(b".".join([b"s"] + [b"t"] * 50 + [b"upid"])) == "stupid"
    words = ["you", "are", "stupid", "and", "the", "loser", "is", "here"] * 4
    vocabulary, which, _ = reader([" ".join("".join(words))])
    assert Counter(vocabulary[i] for i in which) == Counter(words)
    started = time.process_time()
    assert reader.word(b"1" * 20000 + b"d10t").endswith("diot") and time.process_time() - started < 10


def test_numbers_stay_numbers(spark):
    reader = toxicity.Reader(toxicity.language_model(spark.createDataFrame([("in 2019 and 1999 at 4.0 or 100 of 3 by 555-7713 the idiot is here",)] * 50, "text string")))
    for text in ("2010", "100", "4.0", "208.240.42.236"):
        assert reader.word(text.encode()) == text


def test_toxicity_scores_every_row(spark, docs, rows, empty):
    train = [(1000 + i, prose(100 + i, 40) + (" vile scum" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(160)]
    table = docs.select("doc_id", "text").union(spark.createDataFrame([(i, t) for i, t, _ in train], "doc_id long, text string"))
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in train] + [(1, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    out = toxicity.score(table, labels).collect()
    assert len(out) == len(rows) + len(train) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    truth = {i: y for i, _, y in train}
    assert np.mean([r.predicted == truth[r.doc_id] for r in out if r.doc_id in truth]) >= 0.95
    assert toxicity.score(empty, labels.limit(0)).count() == 0


def test_token_files_come_back(spark, docs, rows, empty, tmp_path):
    tokenfile.write(docs, str(tmp_path / "t"), block_ids=500)
    out = tokenfile.load(spark, str(tmp_path / "t"), with_ids=True).orderBy("start").collect()
    enc = tokenfile.encoder(tokenfile.TOKENIZER, True).tokenizer
    want = Counter((r[0], tuple(enc.encode(r[1] or "", add_special_tokens=False).ids + [2])) for r in rows)
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in out) == want
    assert [r.start for r in out] == list(np.cumsum([0] + [r.n_tokens for r in out[:-1]]))
    ids = [r.doc_id for r in out if r.doc_id is not None]
    assert ids == sorted(ids) and all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) for r in out)
    tokenfile.write(empty, str(tmp_path / "e"))
    assert tokenfile.load(spark, str(tmp_path / "e")).count() == 0


def test_byte_coding_of_every_width():
    values = np.array([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1, 7], np.uint32)
    for n in range(len(values) + 1):
        assert tokenfile.decode(*tokenfile.encode(values[:n]), n).tolist() == values[:n].tolist()


def _components(rows):
    sets = []
    for r in rows:
        w = words((r[1] or "").translate(near._LOWERED))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    group = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            a, b = group[i], group[j]
            group = [a if g == b else g for g in group]
    low = {}
    for g, r in zip(group, rows):
        low[g] = min([x for x in (low.get(g), r[0]) if x is not None], default=None)
    return Counter((r[0], len(s), low[g]) for r, s, g in zip(rows, sets, group))


near._LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("sets,blocks,hot", [(3, 64, 8), (2, 1, 2)])
def test_near_duplicates(spark, docs, rows, empty, monkeypatch, sets, blocks, hot):
    # A family of edited copies that link in chains, so that leaders miss members.
    base, family = prose(50, 150, 10**6).split(), []
    for k in range(40):
        w = list(base)
        for j in range(0, min(k, 30)):
            w[(j * 7) % 150] = f"edit{j}"
        family.append((500 + k, " ".join(w), None, None, None, None, None, None, None))
    for name, value in (("BLOCK_SETS", sets), ("BLOCKS", blocks), ("HOT", hot)):
        monkeypatch.setattr(near, name, value)
    every = rows + family
    table = spark.createDataFrame(every, SCHEMA)
    got = near.near_duplicates(table).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == _components(every)
    kept = near.one_of_each(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 0").count() == 1 and kept.where("doc_id in (1, 2)").count() == 0
    assert near.near_duplicates(empty).count() == 0


def test_near_duplicates_of_one_shingle_beside_longer_ones(spark):
    # One shingle, and two of which one is the same: they share a signature and do not link.
    rows = []
    for i in range(40):
        w = prose(100 + i, 9, 10**6).split()
        rows += [(8 * i + n, " ".join(w[:n]), None, None, None, None, None, None, None) for n in (4, 5, 6, 7, 9)]
        rows += [(8 * i + 3, " ".join(w[1:6]), None, None, None, None, None, None, None)]
    got = near.near_duplicates(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == _components(rows)
    assert {r["n_shingles"] for r in got} == {1, 2, 3, 5}


def test_packing_beside_columns_of_the_same_names(spark):
    names = ["_at", "_bin", "_fill", "_gap", "_part", "Offset", "sequence_id"]
    rows = [(i, 1 + i * 37 % 4096, *range(7)) for i in range(300)]
    got = packing.pack(spark.createDataFrame(rows, "id long, length long, " + ", ".join(f"{n} long" for n in names)))
    assert got.columns == ["id", "length", *names[:5], "sequence_id", "offset"] and got.count() == 300
    assert all(tuple(r)[:7] == rows[r.id][:7] for r in got.collect())
    ends = got.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r.n == r.end <= 4096 for r in ends)


def test_training_reads_long_words_whole(spark):
    text = "".join(map(chr, np.random.default_rng(3).integers(97, 123, 5000)))
    docs = spark.createDataFrame([(i, text, "xx") for i in range(3)] + [(9, None, "xx"), (10, "", "xx")], "doc_id long, text string, lang string")
    pieces = {bytes(r.word) for r in language.training_words(docs).collect()}
    places = sorted(text.encode().find(p) for p in pieces)
    assert len(pieces) == language.TRAIN_WORDS and min(places) < 50 and max(places) > 4900


def test_batches_are_bounded_by_characters():
    import pandas as pd

    frame = pd.DataFrame({"text": ["x" * 3_000_000, None, "y" * 3_000_000, "z" * 9_000_000, "", "w"]})
    sizes = []
    for run in (common.in_batches(lambda f: sizes.append(f["text"].str.len().sum()) or f), common.by_bytes(lambda f: f)):
        assert pd.concat(run([frame])).equals(frame)
    assert sizes == [3_000_000, 3_000_000, 9_000_000, 1]


def test_rows_without_an_id_are_spread(spark):
    rows = [(None if i % 2 else i, "s", prose(i, 5 + i % 9, 10**6)) for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string")
    first, second = (sorted(map(str, mix.mix(t).collect())) for t in (table, table.repartition(5)))
    assert first == second and len(first) == 400
    h = F.md5(F.concat(F.lit("mix"), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.md5("text")))))
    assert table.select(h).distinct().count() == 400


def test_long_texts_come_in_bounded_batches(spark):
    def held(frames):
        for frame in frames:
            yield pd.DataFrame({"n": [frame["text"].str.len().sum()]})

    long = spark.range(0, 1_500, 1, 1).select(F.repeat(F.lit("word "), 2_000).alias("text"))
    sizes = [r["n"] for r in long.mapInPandas(held, "n long").collect()]
    assert sum(sizes) == 1_500 * 10_000 and max(sizes) <= BATCH_BYTES + 10_000, sizes


def test_signing_and_block_comparison_hold_little():
    rng = np.random.default_rng(8)
    vocabulary = np.array([f"w{i}" for i in range(5_000)])
    frame = pd.DataFrame({"text": [" ".join(rng.choice(vocabulary, 400)) for _ in range(3_000)]})
    sets = [np.unique(rng.integers(0, 1 << 18, 1_000).astype(np.uint64)) for _ in range(1_000)]
    sign = near._signer(SimpleNamespace(value=np.zeros(0, np.uint64)))

    def most(work):
        tracemalloc.start()
        work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return peak / 1e6

    assert sum(len(x["v"].unique()) for x in sign(iter([frame]))) == 3_000
    assert most(lambda: [len(x) for x in sign(iter([frame]))]) < 60
    assert most(lambda: near.links_between(sets[:500], sets[500:])) < 110


def test_links_between_blocks_equal_all_pairs():
    rng = np.random.default_rng(11)
    base = rng.integers(0, 2**63, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate([rng.permutation(base)[: rng.integers(40, 61)], rng.integers(0, 2**63, rng.integers(0, 9)).astype(np.uint64)])) for _ in range(40)] + [np.arange(3, dtype=np.uint64)]
    similar = lambda x, y: 100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y))
    got, n = near.links_between(sets, None), len(sets)
    # A set with itself is no pair.
    assert all(got[i, j] == similar(sets[i], sets[j]) for i in range(n) for j in range(n) if i != j)
    assert near.links_between(sets[:9], sets[9:]).tolist() == [[similar(x, y) for y in sets[9:]] for x in sets[:9]]


def test_sketches_exclude_no_link():
    rng = np.random.default_rng(21)
    sets = []
    for size in (1, 2, 5, 40, 120, 127, 128, 300, 2000):
        base = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        for keep in (1.0, 0.95, 0.9, 0.8, 0.5):
            drop = rng.permutation(base)[: max(int(len(base) * keep), 1)]
            sets.append(np.unique(np.concatenate([drop, rng.integers(0, 2**63, size // 20).astype(np.uint64)])))
    sketches = [near._sketch(x) for x in sets]
    # Full cells tell nothing.
    sketches[-1] = sketches[-1][:8] + b"\xff" * (len(sketches[-1]) - 8)
    linked, may = near.links_between(sets, None), near.may_link(sketches, sketches)
    off = ~np.eye(len(sets), dtype=bool)
    assert linked[off].sum() > 40 and may[linked & off].all() and may[:-1, :-1].sum() < 0.2 * may.size


def test_groups_go_on_in_the_next_batch():
    rng = np.random.default_rng(22)
    base = rng.integers(0, 2**63, 90).astype(np.uint64)
    rows = []
    for leader, ball, j, count in ((1, False, 0, 6), (1, False, 1, 5), (1, True, 0, 4), (2, False, 0, 1), (3, False, 0, 7)):
        for n in range(count):
            x = np.unique(np.concatenate([base[n % 3 :], rng.integers(0, 2**63, 3).astype(np.uint64)]) if n % 4 else rng.integers(0, 2**63, 90).astype(np.uint64))
            rows.append((leader, ball, 0, j, n % 2 if ball or j else 0, len(rows), n // 5 if leader == 3 else len(rows), near._sketch(x), x.tobytes()))
    frame = pd.DataFrame(rows, columns=[*near._BLOCK, "side", "v", "root", "sketch", "features"])
    near_by = {}
    for key, g in frame.groupby(near._BLOCK):
        pairs = [(p, q) for p in g.itertuples() for q in g.itertuples() if p.root != q.root and (p.side == 0 and q.side == 1 or key[2] == key[3] and not key[1])]
        near_by[key] = {x.v for p, q in pairs if near.may_link([p.sketch], [q.sketch])[0, 0] for x in (p, q)}
    want = set().union(*near_by.values())
    assert 3 < len(want) < len(frame)
    for size in (1, 4, 100):
        got = pd.concat(near._possible(frame.drop(columns="features").iloc[k : k + size] for k in range(0, len(frame), size)))
        assert set(got["v"]) == want and len(got) == len(want) and "sketch" not in got


def test_chance_meetings_carry_no_features(spark, monkeypatch):
    # Two by two they share a passage, which gives them signatures in common but no link.
    texts = []
    for i in range(30):
        passage = prose(900 + i, 110, 10**6)
        texts += [f"{passage} {prose(1000 + 2 * i, 150, 10**6)}", f"{prose(1001 + 2 * i, 150, 10**6)} {passage}"]
    texts.append(texts[0].replace(texts[0].split()[200], "changed"))
    rows = [(None if k % 3 else k, x, None, None, None, None, None, None, None) for k, x in enumerate(texts)]
    met, read, led_rows, feature_sets = [], [], near.led_rows, near.feature_sets
    monkeypatch.setattr(near, "led_rows", lambda *a: met.append(led_rows(*a)) or met[-1])
    monkeypatch.setattr(near, "feature_sets", lambda *a: read.append(feature_sets(*a)) or read[-1])
    got = near.near_duplicates(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == _components(rows)
    assert met[0].select("v").distinct().count() > 10
    assert sum(x.count() for x in read) == 2


def test_leaders_without_a_sort_of_the_group(spark):
    rows = [(1, v) for v in (5, 3, 9, 3, 5)] + [(2, 7), (2, 7), (3, -1), (3, 4)]
    led = near._to_leader(spark.createDataFrame(rows, "sig long, v long"))
    assert "Window" not in led._jdf.queryExecution().toString()
    assert sorted(map(tuple, led.collect())) == [(1, 5, 3), (1, 9, 3), (3, 4, -1)]


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(5)
    none = np.zeros(0, np.uint64)
    for size in [1, 2, 4, 5, 9, 19, 64, 80, 127, 130, 256, 700, 2500] * 8:
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        for extra in (0, len(a) // 9, len(a) // 4):
            drop = (20 * len(a) - 80 * extra) // 100 if extra else 2 * len(a) // 10
            b = np.unique(np.concatenate([rng.permutation(a)[max(drop, 0) :], rng.integers(0, 2**63, extra).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                for seed, common_ones in ((0, none), (3, none), (0, a[::2].copy())):
                    s, t = (near.signatures(x, np.array([0, len(x)]), common_ones, seed)[0] for x in (a, b))
                    assert len(np.intersect1d(s, t))


def test_top_k(spark):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(300, 6))
    points[50:90] = points[50]
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)] + [(300, None), (301, [None] * 6), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (None, [9.0] * 6)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, block_rows=64).collect()
    whole = np.floor(256 * points).astype(int)
    want = set()
    for q in range(0, 300, 50):
        best = sorted((-int(whole[q] @ whole[j]), j) for j in range(300) if j != q)[:5]
        want |= {(q, r + 1, j, -s) for r, (s, j) in enumerate(best)}
    assert {tuple(r) for r in got} == want
    big = spark.createDataFrame([(0, [1e12, 3.0]), (50, [1e12, 1.0]), (51, [2.0, 2.0])], "vec_id long, embedding array<double>")
    assert topk.top_k(big, F.col("vec_id") % 50 == 0).where("query_id = 0").orderBy("rank").first().score == 2**63 - 1
    assert topk.top_k(big.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_boilerplate_lines(docs, rows, empty):
    got = lines.drop_boilerplate(docs)
    assert got.columns == [*docs.columns, "n_dropped"] and got.count() == len(rows)
    by = {r.doc_id: r for r in got.collect()}
    assert all(by[i].n_dropped == 1 and "common line" not in by[i].text for i in range(15, 27))
    assert by[6].text == "" and by[5].text is None and by[0].n_dropped == 0
    assert lines.drop_boilerplate(empty).count() == 0


def test_boilerplate_of_small_and_large_hosts(spark):
    """The fewest pages that make a line boilerplate, for hosts of one page and more."""
    for total, least in ((1, None), (2, 2), (4, 3), (5, 3), (100, 11), (2000, 109)):
        held = lambda n: [(i, ("again\n" if i < n else "") + f"page {i}\n" + "x" * 10, f"h{total}") for i in range(total)]  # noqa: E731, B023
        for n in ([least - 1, least] if least else [1]):
            got = lines.drop_boilerplate(spark.createDataFrame(held(n), "doc_id long, text string, source string"))
            gone = got.where("n_dropped > 0 and text not like '%again%'").count()
            rest = got.where("text like '%again%'").count()
            # The line of x is on all pages.
            assert (gone, rest) == ((total if total > 1 else 0, 0) if n == least else (total - n if total > 1 else 0, n))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    df = queries.QUERIES[name](spark, sf_dir)
    cursor = con.execute(queries.SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert Counter(map(str, (tuple(r[c] for c in names) for r in df.collect()))) == Counter(map(str, cursor.fetchall()))


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, sf_dir))
        assert docs.columns == columns, name
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0]
    assert fill <= 4096 and packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def _plain_quality(rows):
    out = []
    for r in rows:
        w, full = words(r[1]), [x for x in (r[1] or "").split("\n") if words(x)]
        c = Counter(zip(w, w[1:], w[2:]))
        again = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        dup, symbols, chars = len(full) - len(set(full)), sum(map((r[1] or "").count, "#*$%&|<>")), sum(map(len, w))
        if len(w) >= 50 and 2 * len(again) <= len(w) and 4 * symbols <= len(w) and 2 * len(w) <= chars <= 20 * len(w) and not (dup >= 3 and 2 * dup > len(full)):
            out.append(r)
    return out


def _plain_lines(rows):
    pages, seen, out = Counter(r[3] for r in rows), Counter(), []
    trim = lambda x: x.strip(" \t\n\x0b\x0c\r")
    for r in rows:
        seen.update({(r[3], trim(x)) for x in (r[1] or "").split("\n") if trim(x)})
    for r in rows:
        gone = lambda x: trim(x) and seen[r[3], trim(x)] > 1 + 0.05 * pages[r[3]] + 0.95 * math.log(pages[r[3]])  # noqa: B023, E731
        text = None if r[1] is None else "\n".join(x for x in r[1].split("\n") if not gone(x))
        out.append((r[0], text, *r[2:4], None if text is None else len(text)))
    return out


def _plain_near(rows):
    sets = []
    for r in rows:
        w = words((r[1] or "").translate(near._LOWERED))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    group = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and group[i] != group[j]:
            group = [group[i] if g == group[j] else g for g in group]
    first = {}
    for i, (g, s) in enumerate(zip(group, sets)):
        key = (rows[i][0] is None, rows[i][0]) if s else (i,)
        if (g if s else ("blank", i)) not in first or key < first[g if s else ("blank", i)][0]:
            first[g if s else ("blank", i)] = (key, rows[i])
    return [r for _, r in first.values()]


def _plain_mix(rows):
    size, total = [len(words(r[1])) for r in rows], sum(len(words(r[1])) for r in rows)
    order = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    own = {s: sum(n for n, r in zip(size, rows) if r[3] == s) for s in order}
    weight, filled = {s: i % 3 + 1 for i, s in enumerate(order)}, set()
    while True:
        # Sources that their share would fill get all of their epochs, the others what is left.
        rest, open_weight = total - sum(3 * own[s] for s in filled), sum(weight[s] for s in order if s not in filled)
        more = {s for s in order if s not in filled and 3 * own[s] * open_weight <= weight[s] * rest}
        if not more:
            break
        filled |= more
    target = {s: float(3 * own[s]) if s in filled else weight[s] * rest / open_weight for s in order}
    copies, so_far = [], Counter()
    md5 = lambda r: hashlib.md5(f"mix{'-' + hashlib.md5((r[1] or '').encode()).hexdigest() if r[0] is None else r[0]}".encode()).hexdigest()
    for n, r in sorted(zip(size, rows), key=lambda x: (md5(x[1]), x[0])):
        so_far[r[3]] += n
        copies += [((so_far[r[3]] + e * own[r[3]]) / target[r[3]], order.index(r[3]), e, md5(r), n, r) for e in range(3) if n]
    spent, out = 0, []
    for *_, n, r in sorted(copies, key=lambda x: x[:5]):
        spent += n
        if spent > total:
            break
        out.append(r)
    return out


def test_pipeline_against_plain_python(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = list(map(tuple, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()))
    page = lambda i: "Top of the page\n" + prose(700 + i, 70, 10**5) + "\n  Top of the page "
    rows += [(9000 + i, page(i), "en", "small" if i % 2 else None, None) for i in range(14)]
    long = prose(800, 6000, 10**5)
    rows += [(9100, long, "en", "long", 1), (9101, long + " end", "en", "long", 1), rows[0], (None, prose(801, 90), None, "small", 1), (None, None, None, None, None), (9102, "", "en", None, 0)]
    docs = spark.createDataFrame(rows, schema)
    for (name, stage), plain in zip(corpus_pipeline.STAGES, (_plain_quality, _plain_lines, _plain_near, _plain_mix)):
        before, rows = len(rows), plain(rows)
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, sf_dir))
        assert Counter(map(tuple, docs.collect())) == Counter(rows), name
        assert len(rows) < before or name in ("line_dedup", "source_mix")
    assert max(Counter(rows).values()) > 1
    got = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    enc, want = packing.encoder(packing.TOKENIZER, False).tokenizer, Counter()
    for r, n in Counter(rows).items():
        ids = np.array(enc.encode(r[1] or "", add_special_tokens=False).ids + [packing.END_ID], "<u4")
        for at in range(0, len(ids), 4096):
            raw = ids[at : at + 4096].tobytes()
            want.update((r[0], copy, at // 4096, at, len(raw) // 4, zlib.crc32(raw), raw) for copy in range(1, n + 1))
    assert Counter((r.doc_id, r["copy"], r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got) == want
    assert len({(r.doc_id, r["copy"], r.piece) for r in got if r.doc_id is not None}) == sum(r.doc_id is not None for r in got)
    # Best-fit decreasing, one piece after another, gives sequences of the same lengths.
    plain = []
    for n in sorted((x[4] for x in want.elements()), reverse=True):
        fits = [b for b in plain if sum(b) + n <= 4096]
        max(fits, key=sum).append(n) if fits else plain.append([n])
    bins = defaultdict(list)
    for r in sorted(got, key=lambda r: r.offset):
        assert r.offset == sum(bins[r.sequence_id])
        bins[r.sequence_id].append(r.length)
    assert sorted(map(sum, bins.values())) == sorted(map(sum, plain))


@pytest.mark.parametrize("name, spaces", [(packing.TOKENIZER, False), (tokenfile.TOKENIZER, True)])
def test_encoder_equals_whole_texts(name, spaces):
    odd = ["", None, "  ", "\n\n", " a", "a ", "a\n\n  b\t\tc  ", "don't I'LL 12abc!!  x²y Ⱥ ÀÉ İ", "日本 語", "龍 a", "<|endoftext|> a", "x" * 5000, "\r\n a\r\nb", "a\x0bb\x0cc", "1 2 ½ ¼x", "a\n b\n  c"]
    enc = Encoder(name, spaces, limit=40)
    for _ in range(2):
        found = enc(odd) + enc(odd[::-1])
        assert [f.tolist() for f in found] == [e.ids for e in enc.tokenizer.encode_batch([t or "" for t in odd + odd[::-1]], add_special_tokens=False)]
