"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a word's bytes in both directions and labels every byte with a
distribution over the languages; a document's probabilities are the geometric mean
over all its bytes, made to sum to one. It is trained in numpy by backpropagation
through time on words of a bounded sample of labelled documents (``TRAIN_DOCS`` a
language, ``TRAIN_WORDS`` words or pieces of long ones spread over each whole text), then labels all words of
all documents: equal words have equal labels, so each task runs the network once for
each different word it meets.

Languages are the values of ``lang`` among the documents not held out; nothing but the
text enters a prediction. Null texts and texts without a letter are ``und`` with score
0; so are all if no labelled document exists. Repeated rows are predicted alike.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import Words, held_out, in_batches, query, read

TRAIN_DOCS = 300
TRAIN_WORDS = 96
# Languages at most; a vocabulary of labels, not of documents.
LANGUAGES = 256
HIDDEN = 16
STEPS = 500
BATCH = 256
# A longer word is read in pieces.
PIECE = 24
_LETTER = re.compile(r"[^\W\d_]")


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class BiGru:
    """Two gated recurrent layers over bytes and a softmax over both at each byte."""

    def __init__(self, languages: int, hidden: int = HIDDEN, seed: int = 0):
        rng = np.random.default_rng(seed)
        near = lambda *shape: (rng.standard_normal(shape) * shape[0] ** -0.5).astype(np.float32)
        self.p = {"out": near(2 * hidden, languages), "bias": np.zeros(languages, np.float32)}
        for d in "fb":
            self.p["in" + d] = (rng.standard_normal((256, 3 * hidden)) * 0.3).astype(np.float32)
            self.p["rec" + d] = near(hidden, 3 * hidden)
        self.hidden = hidden

    def _run(self, x: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """States after each byte of words ``x`` (words, bytes), in the order of reading."""
        H, U = self.hidden, self.p["rec" + d]
        h, out = np.zeros((len(x), H), np.float32), np.empty((x.shape[1], len(x), H), np.float32)
        for t in range(x.shape[1]):
            a = self.p["in" + d][x[:, t]]
            u = h @ U
            g = _sigmoid(a[:, : 2 * H] + u[:, : 2 * H])
            z, r = g[:, :H], g[:, H:]
            n = np.tanh(a[:, 2 * H :] + r * u[:, 2 * H :])
            new = h + z * (n - h)
            if keep is not None:
                keep.append((h, z, r, n, u[:, 2 * H :]))
            out[t] = h = new
        return out

    def states(self, x: np.ndarray, keep: tuple[list, list] | None = None) -> np.ndarray:
        f = self._run(x, "f", keep and keep[0])
        b = self._run(x[:, ::-1], "b", keep and keep[1])
        return np.concatenate([f, b[::-1]], axis=2)

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        """(bytes, words, languages)."""
        y = self.states(x) @ self.p["out"] + self.p["bias"]
        y -= y.max(axis=2, keepdims=True)
        return y - np.log(np.exp(y).sum(axis=2, keepdims=True))

    def gradients(self, x: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all bytes, and its derivatives back through time."""
        T, N, H = x.shape[1], len(x), self.hidden
        keep: tuple[list, list] = ([], [])
        s = self.states(x, keep)
        y = s @ self.p["out"] + self.p["bias"]
        y -= y.max(axis=2, keepdims=True)
        q = np.exp(y)
        q /= q.sum(axis=2, keepdims=True)
        loss = -float(np.log(np.maximum(q[:, np.arange(N), label], 1e-9)).mean())
        q[:, np.arange(N), label] -= 1
        q /= T * N
        grad = {"out": np.einsum("tnh,tnl->hl", s, q), "bias": q.sum(axis=(0, 1))}
        back = q @ self.p["out"].T
        for k, d in enumerate("fb"):
            U, dU, dE = self.p["rec" + d], np.zeros_like(self.p["rec" + d]), np.zeros_like(self.p["in" + d])
            read, into = (x, back[:, :, :H]) if d == "f" else (x[:, ::-1], back[::-1, :, H:])
            dh = np.zeros((N, H), np.float32)
            for t in range(T - 1, -1, -1):
                h, z, r, n, un = keep[k][t]
                dh = dh + into[t]
                dn = dh * z * (1 - n * n)
                dz = dh * (n - h) * z * (1 - z)
                dr = dn * un * r * (1 - r)
                da = np.concatenate([dz, dr, dn], axis=1)
                du = np.concatenate([dz, dr, dn * r], axis=1)
                dU += h.T @ du
                np.add.at(dE, read[:, t], da)
                dh = dh * (1 - z) + du @ U.T
            grad["rec" + d], grad["in" + d] = dU, dE
        return loss, grad

    def train(self, words: list[bytes], labels: np.ndarray, steps: int = STEPS, batch: int = BATCH, seed: int = 0) -> None:
        """Adam over batches of words of one length, drawn as often as they occur."""
        rng = np.random.default_rng(seed)
        length = np.array([len(w) for w in words])
        by = {n: np.flatnonzero(length == n) for n in np.unique(length) if n}
        if not by:
            return
        sizes = np.array(list(by))
        odds = np.array([len(by[n]) * n for n in sizes], float)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        for step in range(1, steps + 1):
            n = int(rng.choice(sizes, p=odds / odds.sum()))
            some = rng.choice(by[n], batch)
            x = np.frombuffer(b"".join(words[i] for i in some), np.uint8).reshape(batch, n)
            _, grad = self.gradients(x, labels[some])
            rate = 0.02 * (1 - step / (steps + 1)) + 0.001
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                self.p[k] -= (rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)

    def label_words(self, words: list[bytes]) -> np.ndarray:
        """Sum over each word's bytes of the log probabilities of the languages."""
        out = np.zeros((len(words), len(self.p["bias"])), np.float64)
        owner, part = [], []
        for i, w in enumerate(words):
            for at in range(0, len(w), PIECE):
                owner.append(i)
                part.append(w[at : at + PIECE])
        owner, length = np.array(owner, np.int64), np.array([len(p) for p in part], np.int64)
        for n in np.unique(length):
            some = np.flatnonzero(length == n)
            for at in range(0, len(some), 4096):
                chunk = some[at : at + 4096]
                x = np.frombuffer(b"".join(part[i] for i in chunk), np.uint8).reshape(len(chunk), n)
                np.add.at(out, owner[chunk], self.log_probabilities(x).sum(axis=0))
        return out


def training_words(docs: DataFrame, train_docs: int = TRAIN_DOCS, train_words: int = TRAIN_WORDS) -> DataFrame:
    """(lang, word) from a bounded sample of the documents not held out."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "lang", "text")
    # Ids first: texts of the sample only pass the window.
    ids = labelled.select("doc_id", "lang", F.xxhash64("text").alias("h")).withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "h"))).where(F.col("k") <= train_docs)
    ids = ids.orderBy("k", "lang").limit(LANGUAGES * train_docs).select(F.col("doc_id").alias("id"), F.col("lang").alias("l"), "h").distinct()
    chosen = labelled.join(F.broadcast(ids), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("lang") == F.col("l")) & (F.xxhash64("text") == F.col("h"))).select("lang", "text")

    def spread(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for lang, text in zip(frame["lang"], frame["text"]):
            # Pieces of all words, long ones included, evenly over the whole text.
            found = text.encode("utf-8", "surrogatepass").split()
            upto = np.cumsum([-(-len(w) // PIECE) for w in found]) if found else np.zeros(1, np.int64)
            some = np.unique(np.linspace(0, upto[-1] - 1, min(train_words, int(upto[-1]))).astype(int)) if found else []
            for k in some:
                i = int(np.searchsorted(upto, k, side="right"))
                at = PIECE * int(k - (upto[i - 1] if i else 0))
                out.append((lang, found[i][at : at + PIECE]))
        return pd.DataFrame(out, columns=["lang", "word"])

    return chosen.mapInPandas(in_batches(spread), "lang string, word binary")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs`` (doc_id, text, lang)."""
    spark = docs.sparkSession
    # Sorted, so that the same sample trains the same network.
    sample = training_words(docs).toPandas().sort_values(["lang", "word"], ignore_index=True)
    languages = sorted(sample["lang"].unique())
    words = [bytes(w) for w in sample["word"]]
    labels = np.searchsorted(languages, sample["lang"].to_numpy(str)) if languages else np.zeros(0, int)
    if languages:
        # Languages weigh alike, however many words the sample has of each.
        rng = np.random.default_rng(0)
        most = max(np.bincount(labels))
        even = np.concatenate([rng.choice(np.flatnonzero(labels == k), most) for k in range(len(languages))])
        words, labels = [words[i] for i in even], labels[even]
    net = BiGru(max(len(languages), 1))
    net.train(words, labels)
    shared = spark.sparkContext.broadcast((languages, net))

    def predicted(frames):
        names, net = shared.value
        known_hash, known = np.zeros(0, np.uint64), np.zeros((0, len(net.p["bias"])))

        def some(frame: pd.DataFrame) -> pd.DataFrame:
            nonlocal known_hash, known
            found = Words(frame["text"])
            hashes, first, which = np.unique(found.hashes, return_index=True, return_inverse=True)
            place = np.searchsorted(known_hash, hashes)
            new = np.flatnonzero(~((place < len(known_hash)) & (known_hash[np.minimum(place, max(len(known_hash) - 1, 0))] == hashes) if len(known_hash) else np.zeros(len(hashes), bool)))
            raw = found.joined.tobytes()
            fresh = net.label_words([raw[a:b] for a, b in zip(found.starts[first[new]].tolist(), found.ends[first[new]].tolist())])
            if len(known_hash) + len(new) > 1 << 20 and len(known_hash):
                # The memory is full: keep what this batch has.
                old = np.setdiff1d(np.arange(len(hashes)), new)
                known_hash, known = hashes[old], known[place[old]]
            known_hash = np.concatenate([known_hash, hashes[new]])
            order = np.argsort(known_hash)
            known_hash, known = known_hash[order], np.concatenate([known, fresh])[order]
            sums = known[np.searchsorted(known_hash, hashes)][which]
            total = np.concatenate([np.zeros((1, sums.shape[1])), np.cumsum(sums, axis=0)])[found.begins]
            size = np.concatenate([[0], np.cumsum(found.ends - found.starts)])[found.begins]
            mean = np.diff(total, axis=0) / np.maximum(np.diff(size), 1)[:, None]
            q = np.exp(mean - mean.max(axis=1, keepdims=True))
            q /= q.sum(axis=1, keepdims=True)
            known_text = [bool(names) and t is not None and bool(_LETTER.search(t)) for t in frame["text"]]
            best = q.argmax(axis=1)
            return pd.DataFrame({
                "doc_id": frame["doc_id"].astype("Int64"), "held_out": frame["held_out"],
                "lang_pred": [names[b] if k else "und" for b, k in zip(best, known_text)],
                "score": np.where(known_text, q[np.arange(len(q)), best], 0.0),
            })

        yield from in_batches(some, 1024)(frames)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(docs["doc_id"]).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(predicted, "doc_id long, held_out boolean, lang_pred string, score double")


@query("op4_language")
def op4(spark, sf_dir):
    return identify(read(spark, sf_dir, "documents"))
