"""Personal data in texts: fixed patterns, and a bidirectional LSTM with a CRF on top.

The patterns give the base spans of e-mail addresses, IP addresses, card and phone
numbers. A network over single characters adds spans that the patterns cannot read:
``name (at) host.org``, numbers with other separators, addresses with bracketed dots,
phone numbers without a plus sign. Two LSTM layers read a window in both directions,
a linear layer scores the tags (outside, begin and inside of each kind) at every
character, and a conditional random field adds scores of neighbouring tags. It is
trained in numpy, by backpropagation through time from the CRF's marginals, on labelled
spans: base spans of a bounded sample of stretches (``TRAIN_STRETCHES``), part of them
rewritten into the forms above, and made-up numbers that are no personal data.

All kinds need a digit, an @ or a bracketed "at", so only characters within ``CONTEXT``
of one can be in an added span; those stretches are covered by overlapping windows of
``WINDOW`` characters. Each window is decoded by itself into marginals; the marginals are
averaged, a window weighing less towards its edges, and one Viterbi pass over the whole
stretch settles the tags, so that no window edge cuts a span. A tagged span is moved to
the edges of its word or number (``tagged``). An added span must be sure (``SURE``), stand
free, touch no base span and be well formed for its kind (number of digits, Luhn sum,
parts at most 255).

Only text enters a prediction, and texts are read whole: the patterns take time in
proportion to a text's length, also on one long run of digits. Null texts count as
empty; both have no spans. Repeated rows have the same result; spans of several kinds
may start together and are ordered by kind. An empty table, or one without a labelled
span, is judged by the patterns alone. Other columns than doc_id and text are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import by_bytes, query, read

KINDS = ("email", "ip", "card", "phone")
# Stretches that the network learns from, at most, and at most this many of a document.
TRAIN_STRETCHES = 6_000
OF_ONE = 4
WINDOW, STRIDE, CONTEXT = 64, 32, 48
HIDDEN = 20
STEPS, BATCH = 320, 64
SURE = 0.8

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
# A number starts where no digit stands before; inside a run every start ends alike.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANCHOR = re.compile(r"[0-9@]|[(\[{] ?at ?[)\]}]", re.IGNORECASE)
_AT = re.compile(r" ?[(\[{] ?at ?[)\]}] ?|@", re.IGNORECASE)
_DOT = re.compile(r" ?[(\[{] ?(?:dot|\.) ?[)\]}] ?| dot ", re.IGNORECASE)


def _digits(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    twice = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[::-2]) + sum(twice)) % 10 == 0


def _is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _is_card(text: str) -> bool:
    d = _digits(text)
    return 12 <= len(d) <= 19 and luhn(d)


def _is_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' spans, in order."""
    if not text:
        return []
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, 0, domain.end()))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    for kind, pattern, holds in ((1, _IP, _is_ip), (2, _CARD, _is_card), (3, _PHONE, _is_phone)):
        out += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if holds(m.group())]
    return sorted(out)


# Symbols: padding, other characters, letters beyond ASCII, white space, printable ASCII
# (all digits as one: which they are is left to the checks of a span).
_SYMBOLS = 4 + 95


def symbols(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.where((c >= 48) & (c <= 57), 48, c)
    out = np.where((c > 32) & (c < 127), c - 28, np.where(c >= 0xC0, 2, np.where((c == 32) | ((c >= 9) & (c <= 13)), 3, 1)))
    return out.astype(np.int64)


_TAGS = 1 + 2 * len(KINDS)
# Inside follows begin or inside of its kind alone.
_BARRED = np.zeros((_TAGS, _TAGS))
for _k in range(len(KINDS)):
    _BARRED[:, 2 + 2 * _k] = -1e4
    _BARRED[1 + 2 * _k, 2 + 2 * _k] = _BARRED[2 + 2 * _k, 2 + 2 * _k] = 0


def tags_of(length: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Tags of characters; where kinds overlap, the earlier span has them."""
    out = np.zeros(length, np.int64)
    for start, kind, end in spans:
        if not out[start:end].any():
            out[start:end] = 2 + 2 * kind
            out[start] = 1 + 2 * kind
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Tagger:
    """Two LSTM layers over characters, a linear layer and a linear-chain CRF. A window
    may begin inside a span, so its first tag may be any."""

    def __init__(self, hidden: int = HIDDEN, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.p = {"out": rng.standard_normal((2 * hidden, _TAGS)) * hidden**-0.5, "bias": np.zeros(_TAGS), "next": np.zeros((_TAGS, _TAGS)), "first": np.zeros(_TAGS)}
        for d in "fb":
            self.p["in" + d] = rng.standard_normal((_SYMBOLS, 4 * hidden)) * 0.3
            # Forget gates start open.
            self.p["in" + d][:, hidden : 2 * hidden] += 1
            self.p["rec" + d] = rng.standard_normal((hidden, 4 * hidden)) * hidden**-0.5

    def _run(self, x: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        H, U = self.hidden, self.p["rec" + d]
        h, c = np.zeros((len(x), H)), np.zeros((len(x), H))
        out = np.empty((x.shape[1], len(x), H))
        for t in range(x.shape[1]):
            a = self.p["in" + d][x[:, t]] + h @ U
            g = _sigmoid(a[:, : 3 * H])
            i, f, o = g[:, :H], g[:, H : 2 * H], g[:, 2 * H :]
            n = np.tanh(a[:, 3 * H :])
            new = f * c + i * n
            squashed = np.tanh(new)
            if keep is not None:
                keep.append((h, c, i, f, o, n, squashed))
            c, h = new, o * squashed
            out[t] = h
        return out

    def emissions(self, x: np.ndarray, keep: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Scores (characters, windows, tags) and the states they come from."""
        f = self._run(x, "f", keep and keep[0])
        b = self._run(x[:, ::-1], "b", keep and keep[1])
        s = np.concatenate([f, b[::-1]], axis=2)
        return s @ self.p["out"] + self.p["bias"], s

    def marginals(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tag marginals, their sum over neighbours (for the gradient), log partition."""
        T, N, K = e.shape
        A = self.p["next"] + _BARRED
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = self.p["first"] + e[0]
        for t in range(1, T):
            alpha[t] = _lse(alpha[t - 1][:, :, None] + A, 1) + e[t]
        for t in range(T - 2, -1, -1):
            beta[t] = _lse(A + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        z = _lse(alpha[-1], 1)
        pairs = np.zeros((K, K))
        for t in range(1, T):
            pairs += np.exp(alpha[t - 1][:, :, None] + A + (e[t] + beta[t])[:, None, :] - z[:, None, None]).sum(axis=0)
        return np.exp(alpha + beta - z[:, None]), pairs, z

    def gradients(self, x: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood a character, and its derivatives."""
        keep: tuple[list, list] = ([], [])
        e, s = self.emissions(x, keep)
        T, N, K = e.shape
        m, pairs, z = self.marginals(e)
        y = tags.T
        t_at, n_at = np.arange(T)[:, None], np.arange(N)[None, :]
        A = self.p["next"] + _BARRED
        gold = self.p["first"][y[0]] + e[t_at, n_at, y].sum(axis=0) + A[y[:-1], y[1:]].sum(axis=0)
        loss = float((z - gold).mean()) / T
        m[t_at, n_at, y] -= 1
        np.add.at(pairs, (y[:-1].ravel(), y[1:].ravel()), -1)
        m, pairs = m / (T * N), pairs / (T * N)
        grad = {"next": pairs, "first": m[0].sum(axis=0), "out": np.einsum("tnh,tnk->hk", s, m), "bias": m.sum(axis=(0, 1))}
        H, into = self.hidden, m @ self.p["out"].T
        for k, d in enumerate("fb"):
            U, dU, dE = self.p["rec" + d], np.zeros_like(self.p["rec" + d]), np.zeros_like(self.p["in" + d])
            way, back = (x, into[:, :, :H]) if d == "f" else (x[:, ::-1], into[::-1, :, H:])
            dh, dc = np.zeros((N, H)), np.zeros((N, H))
            for t in range(T - 1, -1, -1):
                h, c, i, f, o, n, squashed = keep[k][t]
                dh = dh + back[t]
                dc = dc + dh * o * (1 - squashed**2)
                da = np.concatenate([dc * n * i * (1 - i), dc * c * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - n**2)], axis=1)
                dU += h.T @ da
                np.add.at(dE, way[:, t], da)
                dh, dc = da @ U.T, dc * f
            grad["rec" + d], grad["in" + d] = dU, dE
        return loss, grad

    def train(self, draw, steps: int = STEPS) -> float:
        """Adam on batches of ``draw()``: windows of symbols and their tags."""
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        loss = 0.0
        for step in range(1, steps + 1):
            loss, grad = self.gradients(*draw())
            rate = 0.03 * (1 - step / (steps + 1)) + 0.001
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                self.p[k] = self.p[k] - rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
        return loss

    def window_marginals(self, x: np.ndarray) -> np.ndarray:
        """(windows, characters, tags)."""
        out = [np.zeros((0, x.shape[1], _TAGS))]
        for at in range(0, len(x), 512):
            e, _ = self.emissions(x[at : at + 512])
            out.append(self.marginals(e)[0].transpose(1, 0, 2))
        return np.concatenate(out)


_SHARE = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(float)


def window_starts(begin: int, end: int) -> list[int]:
    """Overlapping windows that cover a stretch, half a window over both of its ends."""
    return list(range(begin - STRIDE, max(end, begin + 1), STRIDE))


def reconciled(marginals: np.ndarray, starts: list[int], begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Tags of a stretch by one Viterbi pass over the windows' averaged marginals, and
    how sure each is."""
    total, weight = np.zeros((end - begin, _TAGS)), np.zeros(end - begin)
    for start, m in zip(starts, marginals):
        a, b = max(start, begin), min(start + WINDOW, end)
        share = _SHARE[a - start : b - start]
        total[a - begin : b - begin] += m[a - start : b - start] * share[:, None]
        weight[a - begin : b - begin] += share
    mean = total / weight[:, None]
    tags = mean.argmax(axis=1)
    starts_free = tags[0] == 0 or tags[0] % 2 == 1
    if starts_free and (_BARRED[tags[:-1], tags[1:]] == 0).all():
        # The best tag of each character makes an allowed path, so it is the best path.
        return tags, mean[np.arange(end - begin), tags]
    score = np.log(np.maximum(mean, 1e-12))
    best = score[0].copy()
    best[2::2] = -1e9
    back = np.zeros((end - begin, _TAGS), np.int64)
    for t in range(1, end - begin):
        paths = best[:, None] + _BARRED
        back[t] = paths.argmax(axis=0)
        best = paths[back[t], np.arange(_TAGS)] + score[t]
    tags = np.zeros(end - begin, np.int64)
    tags[-1] = best.argmax()
    for t in range(end - begin - 1, 0, -1):
        tags[t - 1] = back[t, tags[t]]
    return tags, mean[np.arange(end - begin), tags]


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of a text within CONTEXT characters of what a span needs."""
    out: list[list[int]] = []
    for m in _ANCHOR.finditer(text):
        a, b = max(m.start() - CONTEXT, 0), min(m.end() + CONTEXT, len(text))
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def well_formed(text: str, kind: int) -> bool:
    if kind == 0:
        plain = _DOT.sub(".", _AT.sub("@", text))
        found = base_spans(plain)
        return (0, 0, len(plain)) in found
    if kind == 1:
        plain = re.sub(r"[\s()\[\]{}]", "", text)
        return bool(_IP.fullmatch(plain)) and _is_ip(plain)
    if re.search(r"[^0-9 ()./+\s-]", text):
        return False
    if kind == 2:
        return _is_card(text)
    groups = re.findall("[0-9]+", text)
    return _is_phone(text) and len(groups) > 2 and len(groups[-1]) >= 3 and not re.fullmatch(r"[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}.*", text)


def tagged(text: str, tags: np.ndarray, begin: int) -> list[tuple[int, int, int, int, int]]:
    """(start, kind, end) of the tags of a stretch that begins at ``begin``, each with its
    place in ``tags``. A span ends where its word or number does, inside the stretch."""
    out = []
    for a in np.flatnonzero((tags > 0) & (tags % 2 == 1)).tolist():
        kind = (int(tags[a]) - 1) // 2
        b = a + 1
        while b < len(tags) and tags[b] == tags[a] + 1:
            b += 1
        start, end, limit = begin + a, begin + b, begin + len(tags)
        while start < end and not (text[start].isalnum() or text[start] in "+(_"):
            start += 1
        while start > begin and (_LOCAL.match(text, start - 1) if kind == 0 else text[start - 1].isalnum()):
            start -= 1
        while end > start and not text[end - 1].isalnum():
            end -= 1
        while end < limit and text[end].isalnum():
            end += 1
        if start < end:
            out.append((start, kind, end, a, b))
    return out


def _added(text: str, tags: np.ndarray, sure: np.ndarray, begin: int, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out = []
    for start, kind, end, a, b in tagged(text, tags, begin):
        free = not (start and text[start - 1].isalnum()) and not (end < len(text) and text[end].isalnum())
        if free and sure[a:b].mean() >= SURE and not any(x < end and start < y for x, _, y in base) and well_formed(text[start:end], kind):
            out.append((start, kind, end))
    return out


def find_spans(texts, net: Tagger | None, at_once: int = 4096) -> list[tuple[list, list]]:
    """For each text its base spans and the added ones, (start, kind, end)."""
    out: list[tuple[list, list]] = []
    held: list[tuple[int, str, int, int]] = []
    ready = 0

    def decode():
        nonlocal held, ready
        rows, starts = [], []
        for _, text, begin, end in held:
            own = window_starts(begin, end)
            starts.append(own)
            lo, hi = own[0], own[-1] + WINDOW
            x = np.zeros(hi - lo, np.int64)
            a, b = max(lo, 0), min(hi, len(text))
            x[a - lo : b - lo] = symbols(text[a:b])
            rows += [x[s - lo : s - lo + WINDOW] for s in own]
        if rows:
            m = net.window_marginals(np.array(rows))
            at = 0
            for (i, text, begin, end), own in zip(held, starts):
                tags, sure = reconciled(m[at : at + len(own)], own, begin, end)
                at += len(own)
                out[i][1].extend(_added(text, tags, sure, begin, out[i][0]))
        held, ready = [], 0

    for i, text in enumerate(texts):
        out.append((base_spans(text) if text else [], []))
        if not text or net is None:
            continue
        for begin, end in stretches(text):
            # Endless runs of digits are decoded a part at a time, overlapping.
            for a in range(begin, end, 64 * WINDOW):
                held.append((i, text, a, min(a + 65 * WINDOW, end)))
                ready += (held[-1][3] - a) // STRIDE + 1
                if ready >= at_once:
                    decode()
    decode()
    return [(base, _apart(more)) for base, more in out]


def _apart(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Parts of one long stretch overlap, and so may what they add: the first stays."""
    out: list[tuple[int, int, int]] = []
    for span in sorted(set(spans)):
        if not out or span[0] >= out[-1][2]:
            out.append(span)
    return out


def _rewritten(rng, text: str, kind: int) -> str:
    """A span in a form that the patterns do not read."""
    pick = lambda *x: x[int(rng.integers(len(x)))]
    if kind == 0:
        name, host = text.split("@", 1)
        dot = pick(".", ".", " dot ", "[.]", "(dot)")
        return name + pick("(at)", " (at) ", "[at]", " [at] ") + host.replace(".", dot)
    if kind == 1:
        return pick("[.]", " . ", "(.)").join(text.split("."))
    d = "".join(map(str, _digits(text)))
    if kind == 2:
        return pick(".", "  ", "/", " - ").join(d[i : i + 4] for i in range(0, len(d), 4))
    d = d[-10:]
    sep = pick("-", " ", ".", "/")
    area = pick(f"({d[:-7]}) ", f"{d[:-7]}{sep}", f"({d[:-7]}){sep}")
    return pick("", "", "00 1 ", "1-", "1 ") + area + d[-7:-4] + sep + d[-4:]


def _no_data(rng) -> str:
    n = lambda *x: int(rng.integers(*x))
    return [
        f"{n(1900, 2030)}-{n(1, 13):02}-{n(1, 29):02}", f"{n(1, 29)}/{n(1, 13)}/{n(1900, 2030)}", f"{n(0, 24):02}:{n(0, 60):02}:{n(0, 60):02}", f"v{n(0, 9)}.{n(0, 20)}.{n(0, 9)}",
        f"{n(1, 999)},{n(0, 999):03}.{n(0, 99):02}", f"{n(1, 100)}%", f"{n(1, 10**9)}", f"{n(1, 2**60):x}", f"#{n(1, 9999)}", f"{n(1900, 2030)}-{n(1900, 2030)}", f"@{n(1, 99)}", f"{n(1, 99)} {n(1, 99)} {n(1, 99)}",
    ][n(12)]


def training_windows(samples: list[tuple[str, list[tuple[int, int, int]]]], batch: int = BATCH, seed: int = 0):
    """A function that draws windows and tags from labelled stretches; kinds weigh alike."""
    rng = np.random.default_rng(seed)
    by = [[i for i, (_, spans) in enumerate(samples) if any(k == kind for _, k, _ in spans)] for kind in range(len(KINDS))]
    some = [b for b in by if b] + [list(range(len(samples)))]

    def one() -> tuple[np.ndarray, np.ndarray]:
        group = some[int(rng.integers(len(some)))]
        text, spans = samples[group[int(rng.integers(len(group)))]]
        parts, labels, at = [], [], 0
        for start, kind, end in spans:
            if start < at:
                continue
            parts.append((text[at:start], -1))
            draw = rng.random()
            if draw < 0.45:
                parts.append((_rewritten(rng, text[start:end], kind), kind))
            elif draw < 0.6:
                parts.append((_no_data(rng), -1))
            else:
                parts.append((text[start:end], kind))
            at = end
        parts.append((text[at:], -1))
        if rng.random() < 0.3:
            parts.append((" " + _no_data(rng) + " ", -1))
        for part, kind in parts:
            tag = np.full(len(part), 0 if kind < 0 else 2 + 2 * kind)
            if kind >= 0 and len(part):
                tag[0] = 1 + 2 * kind
            labels.append(tag)
        whole, tags = "".join(p for p, _ in parts), np.concatenate(labels)
        # Anywhere, also over either end.
        start = int(rng.integers(-STRIDE, max(len(whole) - STRIDE, 1 - STRIDE)))
        x, y = np.zeros(WINDOW, np.int64), np.zeros(WINDOW, np.int64)
        a, b = max(start, 0), min(start + WINDOW, len(whole))
        x[a - start : b - start] = symbols(whole[a:b])
        y[a - start : b - start] = tags[a:b]
        return x, y

    def draw():
        rows = [one() for _ in range(batch)]
        return np.array([x for x, _ in rows]), np.array([y for _, y in rows])

    return draw


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def training_stretches(docs: DataFrame, most: int = TRAIN_STRETCHES, of_one: int = OF_ONE) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """At most ``most`` different stretches with their base spans, by hash: few of each
    document, and the same on each run."""

    def cut(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for text in frame["text"]:
            base = base_spans(text)
            found = stretches(text)
            labelled = [(a, b) for a, b in found if any(a <= s < b for s, _, _ in base)]
            for a, b in (labelled + [f for f in found if f not in set(labelled)])[:of_one]:
                b = min(b, a + 8 * WINDOW)
                # A span that the cut parts has no label.
                spans = [(s - a, k, e - a) for s, k, e in base if s >= a and e <= b]
                out.append((text[a:b], ",".join(f"{s}:{k}:{e}" for s, k, e in spans)))
        return pd.DataFrame(out, columns=["stretch", "spans"])

    some = _rows(docs).where(F.col("text").rlike("[0-9@]")).mapInPandas(by_bytes(cut), "stretch string, spans string")
    held = some.where("stretch is not null").distinct().orderBy(F.xxhash64("stretch"), "stretch").limit(most).toPandas()
    return [(t, [tuple(map(int, x.split(":"))) for x in s.split(",") if x]) for t, s in zip(held["stretch"], held["spans"])]


def trained(docs: DataFrame, steps: int = STEPS) -> Tagger | None:
    samples = training_stretches(docs)
    if not any(spans for _, spans in samples):
        return None
    net = Tagger()
    net.train(training_windows(samples), steps)
    return net


def personal_data(docs: DataFrame, net: Tagger | None = None) -> DataFrame:
    """doc_id, base and added (arrays of start, end, kind in order of start, then of kind)
    for every row of ``docs``. Without ``net`` one is trained on ``docs``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(net or trained(docs))

    def found(frame: pd.DataFrame) -> pd.DataFrame:
        rows = find_spans(frame["text"], shared.value)
        named = lambda spans: [{"start": s, "end": e, "kind": KINDS[k]} for s, k, e in spans]
        return pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "base": [named(b) for b, _ in rows], "added": [named(a) for _, a in rows]})

    kind = "array<struct<start:long,end:long,kind:string>>"
    return _rows(docs).mapInPandas(by_bytes(found), f"doc_id long, base {kind}, added {kind}")


def _listed(spans):
    one = F.transform(spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))
    return F.array_join(one, ",")


@query("op12_pii")
def op12(spark, sf_dir):
    found = personal_data(read(spark, sf_dir, "documents"))
    place = F.create_map(*[x for k, kind in enumerate(KINDS) for x in (F.lit(kind), F.lit(k))])
    both = F.transform(F.concat("base", "added"), lambda s: F.struct(s["start"].alias("start"), place[s["kind"]].alias("k"), s["end"].alias("end"), s["kind"].alias("kind")))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, lambda k: k == F.lit(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.array_sort(both)).alias("spans"), F.size("added").cast("long").alias("n_added"))
