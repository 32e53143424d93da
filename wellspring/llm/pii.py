"""Personal data: base patterns, and a character BiLSTM with CRF transitions.

The model is trained in NumPy from labelled spans: those of the base patterns in
a bounded sample of rows, and the same spans written otherwise (telephone numbers
without a plus or with dots, addresses with " at " and " dot ", IP addresses with
" dot " or "[.]", card numbers with dots or spaced hyphens). It reads overlapping
windows of characters around every digit, at-sign and word "at" or "dot", and on
to the end of the address characters there: each of these forms has one of them
within reach of all its parts. Windows' scores are averaged where they overlap, and one
Viterbi path is decoded over each connected stretch, so a span is decided once,
however windows cut it. Decoded spans that touch no base span and pass their
kind's form are added, IP addresses and card numbers under the base's checks.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.spans import Covered, Span, digest, listed

KINDS = ["email", "ip", "card", "phone"]
WINDOW, STRIDE = 64, 32
SAMPLE_ROWS, ROW_WINDOWS = 1_500, 6  # labelled rows, and windows a row, that the model is fitted on
STEPS, BATCH, RATE = 260, 64, 0.02
EMBED, HIDDEN = 10, 14
MARGIN = 0.5  # mean advantage a character over "outside" for a span to be added

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANCHOR = re.compile(r"[0-9@]")
_WORDED = re.compile(r"(?<![A-Za-z0-9])(?:at|dot)(?![A-Za-z0-9])", re.I)
_SPELLED = r"\S\s?(?:\[at\]|\(at\)|(?<![A-Za-z0-9])at(?![A-Za-z0-9]))\s?\S+?(?:\sdot\s|\.)\S"  # an address without its at-sign
_ADDRESS = re.compile(_SPELLED, re.I)
_HOST = r"[A-Za-z0-9-]+"
_FORM = {  # of data written otherwise; a decoded span grows to the end of the form that it touches
    0: re.compile(rf"[A-Za-z0-9._%+-]+(?:\sdot\s[A-Za-z0-9._%+-]+)*(?:\s?\[at\]\s?|\s?\(at\)\s?|\sat\s){_HOST}(?:(?:\sdot\s|\.){_HOST})+", re.I),
    1: re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\s?\[(?:\.|dot)\]\s?|\s?\((?:\.|dot)\)\s?|\sdot\s|\.)[0-9]{1,3}){3}(?![0-9])", re.I),
    2: re.compile(r"(?<![0-9])[0-9](?:(?:\x20?[._/-]\x20?|\x20)?[0-9])+"),
}
FORM_REACH = 256  # an address has at most 254 characters
_LOOSE = {
    0: re.compile(rf".*\S\s?@\s?\S.*|.*{_SPELLED}.*", re.S | re.I),
    1: re.compile(r"[0-9]+(?:\s?[\[(]?(?:\.|dot)[\])]?\s?[0-9]+){3}", re.I),
    2: re.compile(r"[0-9](?:[\x20._/-]{0,3}[0-9])+"),
    3: re.compile(r"[(0-9][0-9().\x20-]+[0-9]"),
}


def _digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def in_range(parts: list[str]) -> bool:
    parts = [p.lstrip("0") for p in parts]
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind, failing ones dropped."""
    if not _ANCHOR.search(text):
        return []
    found: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:  # a match begins with the run of local characters before an at-sign
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            done = match.end()
            found.append((start, 0, done))
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if in_range(m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 40 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


# ---- the model ----

_SIGNS = "@.-_%+() \n:=\"',/#[]"  # signs with a class of their own
AT, DOT = 6 + len(_SIGNS), 7 + len(_SIGNS)  # letters of the words "at" and "dot"
CLASSES = 8 + len(_SIGNS)
_LOCAL_CLASS = np.isin(np.arange(CLASSES), [1, 2, 3, AT, DOT, *[6 + _SIGNS.index(c) for c in "@.-_%+"]])


def classes_of(text: str) -> np.ndarray:
    """Class of every code point: 0 is padding."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.full(len(code), 5, np.int64)
    out[(code >= 97) & (code <= 122)] = 1
    out[(code >= 65) & (code <= 90)] = 2
    out[(code >= 48) & (code <= 57)] = 3
    out[code >= 0xC0] = 4
    for i, sign in enumerate(_SIGNS):
        out[code == ord(sign)] = 6 + i
    for m in _WORDED.finditer(text):
        out[m.start() : m.end()] = AT if m.end() - m.start() == 2 else DOT
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BiLstmCrf:
    """Two LSTMs over classes, a linear layer to tag scores, and tag transitions."""

    def __init__(self, tags: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        w = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
        self.p = {"embed": w(CLASSES, EMBED), "out": w(2 * HIDDEN, tags) * 0.5, "bias": np.zeros(tags), "move": np.zeros((tags, tags))}
        for side in "fb":
            self.p[f"w{side}"] = w(EMBED + HIDDEN, 4 * HIDDEN)
            self.p[f"b{side}"] = np.concatenate([np.ones(HIDDEN), np.zeros(3 * HIDDEN)])

    def _run(self, x, side, keep):
        """x: (T, B, EMBED), forwards. Hidden states, and what the way back needs."""
        steps, batch = x.shape[:2]
        h, c = np.zeros((batch, HIDDEN)), np.zeros((batch, HIDDEN))
        hidden, saved = np.zeros((steps, batch, HIDDEN)), []
        for t in range(steps):
            z = np.concatenate([x[t], h], axis=1)
            g = z @ self.p[f"w{side}"] + self.p[f"b{side}"]
            gate, new = _sigmoid(g[:, : 3 * HIDDEN]), np.tanh(g[:, 3 * HIDDEN :])
            forget, take, show = gate[:, :HIDDEN], gate[:, HIDDEN : 2 * HIDDEN], gate[:, 2 * HIDDEN :]
            before, c = c, forget * c + take * new
            squashed = np.tanh(c)
            h = show * squashed
            hidden[t] = h
            if keep:
                saved.append((z, forget, take, show, new, before, squashed))
        return hidden, saved

    def scores(self, ids, keep=False):
        """ids: (T, B). Tag scores (T, B, tags)."""
        x = self.p["embed"][ids]
        forth, saved_f = self._run(x, "f", keep)
        back, saved_b = self._run(x[::-1], "b", keep)
        both = np.concatenate([forth, back[::-1]], axis=2)
        return both @ self.p["out"] + self.p["bias"], (both, saved_f, saved_b)

    def _back(self, dh, saved, side, grads):
        dx = np.zeros((len(saved), dh.shape[1], EMBED))
        next_h, next_c = np.zeros(dh.shape[1:]), np.zeros(dh.shape[1:])
        for t in range(len(saved) - 1, -1, -1):
            z, forget, take, show, new, before, squashed = saved[t]
            d = dh[t] + next_h
            dc = next_c + d * show * (1 - squashed**2)
            dg = np.concatenate(
                [dc * before * forget * (1 - forget), dc * new * take * (1 - take), d * squashed * show * (1 - show), dc * take * (1 - new**2)],
                axis=1,
            )
            grads[f"w{side}"] += z.T @ dg
            grads[f"b{side}"] += dg.sum(axis=0)
            dz = dg @ self.p[f"w{side}"].T
            dx[t], next_h, next_c = dz[:, :EMBED], dz[:, EMBED:], dc * forget
        return dx

    def gradients(self, ids, tags):
        """Of the negative log-likelihood of the tag paths, a window's mean."""
        steps, batch = ids.shape
        scores, (both, saved_f, saved_b) = self.scores(ids, True)
        move = self.p["move"]
        alpha, beta = np.zeros_like(scores), np.zeros_like(scores)
        alpha[0] = scores[0]
        for t in range(1, steps):
            alpha[t] = scores[t] + _logsum(alpha[t - 1][:, :, None] + move, 1)
            s = steps - 1 - t
            beta[s] = _logsum(move + (scores[s + 1] + beta[s + 1])[:, None, :], 2)
        total = _logsum(alpha[-1], 1)
        ds = np.exp(alpha + beta - total[None, :, None])
        dmove = np.zeros_like(move)
        for t in range(1, steps):
            dmove += np.exp(alpha[t - 1][:, :, None] + move + (scores[t] + beta[t])[:, None, :] - total[:, None, None]).sum(axis=0)
        ds[np.arange(steps)[:, None], np.arange(batch)[None, :], tags] -= 1
        np.subtract.at(dmove, (tags[:-1].ravel(), tags[1:].ravel()), 1)
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        ds, dmove = ds / batch, dmove / batch
        grads["move"] = dmove
        grads["out"] = np.einsum("tbh,tbk->hk", both, ds)
        grads["bias"] = ds.sum(axis=(0, 1))
        dboth = ds @ self.p["out"].T
        dx = self._back(dboth[:, :, :HIDDEN], saved_f, "f", grads)
        dx += self._back(dboth[::-1, :, HIDDEN:], saved_b, "b", grads)[::-1]
        np.add.at(grads["embed"], ids.ravel(), dx.reshape(-1, EMBED))
        return grads

    def fit(self, ids, tags, seed=4):
        """ids, tags: (windows, T)."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, STEPS + 1):
            chosen = rng.integers(0, len(ids), BATCH)
            for k, g in self.gradients(ids[chosen].T, tags[chosen].T).items():
                g = np.clip(g, -5, 5)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                rate = RATE * (1 - 0.8 * step / STEPS)
                self.p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def path(self, scores):
        """The best tag path of one stretch: scores (T, tags)."""
        best, back = scores[0], []
        for row in scores[1:]:
            through = best[:, None] + self.p["move"]
            back.append(through.argmax(axis=0))
            best = through.max(axis=0) + row
        tags = [int(best.argmax())]
        for step in reversed(back):
            tags.append(int(step[tags[-1]]))
        return np.array(tags[::-1])


def _logsum(x, axis):
    most = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - most).sum(axis=axis)) + np.squeeze(most, axis)


def stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of a text within STRIDE characters of a digit, an at-sign, or a word "at" or "dot".

    An edge inside a run of address characters moves to the end of the run.
    """
    near = np.flatnonzero((ids == 3) | (ids == 6) | (ids == AT) | (ids == DOT))
    if not len(near):
        return []
    cut = np.flatnonzero(np.diff(near) > 2 * STRIDE) + 1
    stops = np.flatnonzero(~_LOCAL_CLASS[ids])
    edges = np.concatenate([[-1], stops, [len(ids)]])
    out: list[tuple[int, int]] = []
    for g in np.split(near, cut):
        a, b = max(0, int(g[0]) - STRIDE), min(len(ids), int(g[-1]) + STRIDE + 1)
        a, b = int(edges[np.searchsorted(edges, a) - 1]) + 1, int(edges[np.searchsorted(edges, b)])
        if out and a <= out[-1][1]:
            a = out.pop()[0]
        out.append((a, b))
    return out


def decode(model: BiLstmCrf, text: str) -> list[tuple[int, int, int, float]]:
    """(start, kind, end, margin) of the model's spans in a whole text."""
    found = []
    ids = classes_of(text)
    for a, b in stretches(ids):
        if not _ANCHOR.search(text, a, b) and not _ADDRESS.search(text, max(0, a - FORM_REACH), b + FORM_REACH):
            continue  # without digit or at-sign only a spelled address passes its form
        places = list(range(a, max(a + 1, b - WINDOW + STRIDE), STRIDE))
        total, weight = np.zeros((b - a, len(KINDS) + 1)), np.zeros(b - a)
        for at in range(0, len(places), 256):
            some = places[at : at + 256]
            windows = np.zeros((len(some), WINDOW), np.int64)
            for row, p in zip(windows, some, strict=True):
                row[: min(WINDOW, b - p)] = ids[p : min(p + WINDOW, b)]
            scores, _ = model.scores(windows.T)
            ramp = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(float)
            for i, p in enumerate(some):
                n = min(WINDOW, b - p)
                total[p - a : p - a + n] += scores[:n, i] * ramp[:n, None]
                weight[p - a : p - a + n] += ramp[:n]
        scores = total / weight[:, None]
        tags = model.path(scores)
        edges = np.flatnonzero(np.diff(tags)) + 1
        for s, e in zip([0, *edges], [*edges, len(tags)], strict=True):
            if tag := int(tags[s]):
                found.append((a + int(s), tag - 1, a + int(e), float((scores[s:e, tag] - scores[s:e, 0]).mean())))
    return found


def _otherwise(text: str, kind: int) -> list[str]:
    """The same datum in other forms."""
    if kind == 3:
        d = _digits(text)[-10:]
        if len(d) < 10:
            return []
        return [f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}"]
    if kind == 0:
        return [text.replace("@", " at ").replace(".", " dot "), text.replace("@", "[at]")]
    if kind == 1:
        return [text.replace(".", " dot "), text.replace(".", "[.]")]
    d = _digits(text)
    fours = [d[i : i + 4] for i in range(0, len(d), 4)]
    return [".".join(fours), " - ".join(fours)]


def labelled_windows(text: str) -> list[tuple[str, list[Span]]]:
    """Windows around base spans, other numbers and words "at" or "dot", and the same with the spans written otherwise."""
    spans, out = base_spans(text), []
    known = Covered(spans)
    places = [a for a, _, _ in spans] + [m.start() for m in re.finditer(r"[0-9@]", text) if known.clear(m.start(), m.start() + 1)][:: 1 + STRIDE // 4]
    for m in _WORDED.finditer(text):  # of no address, so far as the form tells
        if known.clear(m.start(), m.end()) and not _ADDRESS.search(text, max(0, m.start() - WINDOW), m.end() + WINDOW):
            places.append(m.start())
    for n, place in enumerate(sorted(places)):
        a = max(0, place - (place * 7 + n * 13) % 40)
        window = text[a : a + WINDOW]
        inside = [(max(s, a) - a, k, min(e, a + WINDOW) - a) for s, k, e in known.overlapping(a, a + WINDOW)]
        out.append((window, inside))
        for s, k, e in known.starting(place):
            if s < a or e > a + WINDOW:
                continue
            for other in _otherwise(text[s:e], k):
                changed = text[a:s] + other + text[e : a + WINDOW]
                out.append((changed[:WINDOW], [(s - a, k, min(s - a + len(other), WINDOW))]))
    return out


def _window_pass(batches):
    """(text, spans) of at most ROW_WINDOWS windows a row, those with the least digest."""
    for batch in batches:
        texts, spans = [], []
        for text in batch.column(0).to_pylist():
            chosen = sorted(labelled_windows(text or ""), key=lambda w: digest(w[0]))[:ROW_WINDOWS]
            texts += [w for w, _ in chosen]
            spans += [[v for s in inside for v in s] for _, inside in chosen]
        yield pa.record_batch([pa.array(texts, pa.string()), pa.array(spans, pa.list_(pa.int32()))], ["text", "spans"])


def train(docs: DataFrame, rows: int = SAMPLE_ROWS) -> BiLstmCrf | None:
    """Fitted on windows of the ``rows`` rows with a number or at-sign that have the least hash of their id."""
    hit = docs.filter(F.col("text").rlike("[0-9@]"))
    ids = hit.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    one = docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))  # of a repeated id the least text
    table = one.select("text").mapInArrow(_window_pass, "text string, spans array<int>").toArrow()
    windows = sorted(set(zip(table["text"].to_pylist(), map(tuple, table["spans"].to_pylist()), strict=True)))
    windows = sorted(windows, key=lambda w: digest(w[0]))[: rows * ROW_WINDOWS]
    if not windows:
        return None
    ids_, tags = np.zeros((len(windows), WINDOW), np.int64), np.zeros((len(windows), WINDOW), np.int64)
    for i, (text, flat) in enumerate(windows):
        c = classes_of(text)[:WINDOW]
        ids_[i, : len(c)] = c
        for s, k, e in zip(flat[::3], flat[1::3], flat[2::3], strict=True):
            tags[i, s:e] = k + 1
    return BiLstmCrf(len(KINDS) + 1).fit(ids_, tags)


def grown(text: str, a: int, kind: int, b: int) -> tuple[int, int]:
    """The form of the kind that overlaps the span most, or the span where none does."""
    found = _FORM[kind].finditer(text, max(0, a - FORM_REACH), b + FORM_REACH) if kind in _FORM else ()
    shared = [(min(m.end(), b) - max(m.start(), a), m.start(), m.end()) for m in found]
    most = max(shared, default=(0, a, b))
    return most[1:] if most[0] > 0 else (a, b)


def added_spans(model: BiLstmCrf | None, text: str, base: list[Span]) -> list[Span]:
    if model is None or not (_ANCHOR.search(text) or _WORDED.search(text)):
        return []
    known, out = Covered(base), []  # sorted and apart from each other
    for a, kind, b, margin in decode(model, text):
        while a < b and text[a] in " \n.,;:)-":
            a += 1
        while b > a and text[b - 1] in " \n.,;:(-":
            b -= 1
        if margin >= MARGIN and a < b:
            a, b = grown(text, a, kind, b)
        piece = text[a:b]
        if margin < MARGIN or not _LOOSE[kind].fullmatch(piece) or not known.clear(a, b):
            continue
        at = bisect_left(out, (a, kind, b))
        if (at and out[at - 1][2] > a) or (at < len(out) and out[at][0] < b):
            continue
        if kind == 1 and not in_range(re.findall("[0-9]+", piece)):
            continue
        if kind == 2 and not (12 <= len(d := _digits(piece)) <= 19 and luhn(d)):
            continue
        if kind == 3 and not 9 <= len(_digits(piece)) <= 15:
            continue
        if (a and text[a - 1].isalnum()) or (b < len(text) and text[b].isalnum()):
            continue
        out.insert(at, (a, kind, b))
    return out


def _find_pass(model):
    def run(batches):
        net = _model(model.value)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                every = sorted(base + added_spans(net, text or "", base))
                counts = [sum(k == i for _, k, _ in base) for i in range(len(KINDS))]
                rows.append((*counts, digest(listed(base, KINDS)), listed(every, KINDS)))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.record_batch(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

    return run


def _redact_pass(model):
    def run(batches):
        net = _model(model.value)
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                if text:
                    base = base_spans(text)
                    text = redacted(text, base + added_spans(net, text, base))
                out.append(text)
            yield pa.record_batch([pa.array(out, pa.string()), *batch.columns[1:]], batch.schema.names)

    return run


def redacted(text: str, spans: list[Span]) -> str:
    """Spans replaced by their kind in angle brackets; overlapping ones by the first one's."""
    out, done = [], 0
    for a, k, b in sorted(spans):
        if a >= done:
            out += [text[done:a], f"<{KINDS[k]}>"]
        done = max(done, b)
    return "".join(out) + text[done:]


def _broadcast(docs: DataFrame):
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = train(own)
    return docs.sparkSession.sparkContext.broadcast(model and model.p)  # plain arrays


def _model(weights):
    if weights is None:
        return None
    model = BiLstmCrf(len(KINDS) + 1)
    model.p = weights
    return model


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): counts of base spans, their digest, and all spans.

    A null text counts as empty: no spans, the digest of the empty string.
    Repeated rows and null ids give rows like any other. Without any number or
    at-sign in the table there is no model, and base spans are all. Offsets are
    code points, the end exclusive. An empty table gives no rows; other columns
    are not read.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(
        _find_pass(_broadcast(docs)),
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string",
    )


def redact_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with all found spans replaced by their kind; every other column and row as it was."""
    names = [c for c in docs.columns if c != "text"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)
    done = docs.select("text", *names).mapInArrow(_redact_pass(_broadcast(docs)), f"text string, {fields}")
    return done.select(*docs.columns)
