"""Personal data: patterns, and a character-level bidirectional LSTM with CRF transitions.

The patterns find what has the exact form of an address or a number. The model
is trained from those findings and from rewritten forms of them (a telephone
number without its plus sign, an address with blanks around its @), and adds
what the patterns miss. It reads overlapping windows. Each is decoded by
itself; pieces of one span that windows' edges cut are joined, and the spans
proposed are then reconciled over the whole text by choosing the set without
overlaps that has the highest total score.

Every kind holds an @ or a digit. That is a hard constraint of the decoder, so
windows are laid only where a text has one: elsewhere all characters are
outside by the constraint.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from starmill.llm.common import map_arrow

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin where a run of digits begins
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _parts_fit(address: str) -> bool:
    return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in address.split("."))


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind, by kind and start. Time grows with the length of the text."""
    found: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            found.append(("email", start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if _parts_fit(m[0])]
    found += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


@dataclass(frozen=True)
class PiiModel:
    """Sizes and training settings. ``documents`` bounds the labelled sample."""

    documents: int = 300
    window: int = 48
    stride: int = 24
    hidden: int = 16
    steps: int = 240
    batch: int = 64
    rate: float = 0.02
    seed: int = 11
    #: Mean probability of a span's tags from which it is proposed.
    least_score: float = 0.6


#: Symbols: each of these characters, then lower-case letters, then classes.
_OWN = "@.+-() _%:/=#,;\n\"'"
_SYMBOLS = {c: i + 1 for i, c in enumerate(_OWN)}
_DIGIT, _UPPER, _OTHER_LETTER, _OTHER = (len(_OWN) + 27 + i for i in range(4))
_N_SYMBOLS = len(_OWN) + 31
_TAGS = 1 + 2 * len(KINDS)


@lru_cache(maxsize=1 << 16)
def _symbol(c: str) -> int:
    if c in _SYMBOLS:
        return _SYMBOLS[c]
    if "a" <= c <= "z":
        return len(_OWN) + 1 + ord(c) - 97
    if "0" <= c <= "9":
        return _DIGIT
    if "A" <= c <= "Z":
        return _UPPER
    return _OTHER_LETTER if c.isalpha() else _OTHER


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    """Weights of the network. Time is the first axis, windows are the second; symbol 0 is padding."""

    def __init__(self, how: PiiModel):
        rng = np.random.default_rng(how.seed)
        h = how.hidden
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        self.h = h
        self.p = {}
        for d in "fb":
            self.p[f"x{d}"], self.p[f"h{d}"], self.p[f"c{d}"] = rng.normal(0, 0.3, (_N_SYMBOLS, 4 * h)), draw(h, 4 * h), np.zeros(4 * h)
            self.p[f"c{d}"][h : 2 * h] = 1  # open forget gates
        self.p["w"], self.p["e"], self.p["t"] = draw(2 * h, _TAGS), np.zeros(_TAGS), np.zeros((_TAGS, _TAGS))
        self.p["e"][0] = 2
        # a span's inner tag follows only a tag of the same kind
        self.barred = np.zeros((_TAGS, _TAGS), bool)
        for inner in range(2, _TAGS, 2):
            self.barred[:, inner] = True
            self.barred[[inner - 1, inner], inner] = False

    def _run(self, x: np.ndarray, d: str) -> tuple[np.ndarray, tuple]:
        n, width, h = len(x), x.shape[1], self.h
        inputs = self.p[f"x{d}"][x] + self.p[f"c{d}"]
        out, gates = np.zeros((n + 1, width, h)), np.empty((n, width, 4 * h))
        cells, squashed = np.zeros((n + 1, width, h)), np.empty((n, width, h))
        for t in range(n):
            z = inputs[t] + out[t] @ self.p[f"h{d}"]
            z[:, : 3 * h] = _sigmoid(z[:, : 3 * h])
            z[:, 3 * h :] = np.tanh(z[:, 3 * h :])
            cells[t + 1] = z[:, h : 2 * h] * cells[t] + z[:, :h] * z[:, 3 * h :]
            squashed[t] = np.tanh(cells[t + 1])
            out[t + 1] = z[:, 2 * h : 3 * h] * squashed[t]
            gates[t] = z
        return out[1:], (out[:-1], gates, cells, squashed)

    def emissions(self, x: np.ndarray) -> tuple[np.ndarray, tuple]:
        a, ka = self._run(x, "f")
        b, kb = self._run(x[::-1], "b")
        both = np.concatenate([a, b[::-1]], axis=2)
        return both @ self.p["w"] + self.p["e"], (both, ka, kb)

    def _transitions(self) -> np.ndarray:
        return np.where(self.barred, -1e4, self.p["t"])

    @property
    def _first(self) -> np.ndarray:
        tags = np.arange(_TAGS)
        return np.where((tags > 0) & (tags % 2 == 0), -1e4, 0.0)

    def _back(self, x: np.ndarray, kept: tuple, dout: np.ndarray, d: str, grads: dict) -> None:
        (before, gates, cells, squashed), h = kept, self.h
        dz = np.empty_like(gates)
        dh, dc = np.zeros_like(before[0]), np.zeros_like(before[0])
        for t in range(len(x) - 1, -1, -1):
            i, f, o, g = (gates[t, :, k * h : (k + 1) * h] for k in range(4))
            dh = dh + dout[t]
            dc = dc + dh * o * (1 - squashed[t] ** 2)
            dz[t] = np.concatenate([dc * g * i * (1 - i), dc * cells[t] * f * (1 - f), dh * squashed[t] * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            dh, dc = dz[t] @ self.p[f"h{d}"].T, dc * f
        flat = dz.reshape(-1, 4 * h)
        shown = np.zeros((len(flat), _N_SYMBOLS))
        shown[np.arange(len(flat)), x.ravel()] = 1
        grads[f"x{d}"], grads[f"h{d}"], grads[f"c{d}"] = shown.T @ flat, before.reshape(-1, h).T @ flat, flat.sum(0)

    def _sums(self, e: np.ndarray) -> tuple[np.ndarray, ...]:
        """Forward and backward sums over tag sequences, each step scaled to one: alpha, beta, scale, exp(e), exp(transitions), largest e."""
        n, top = len(e), e.max(2, keepdims=True)
        pe, pt = np.exp(e - top), np.exp(self._transitions())
        alpha, beta, scale = np.empty_like(e), np.ones_like(e), np.empty((n, e.shape[1], 1))
        for t in range(n):
            a = pe[t] * (alpha[t - 1] @ pt if t else np.exp(self._first))
            scale[t] = a.sum(1, keepdims=True)
            alpha[t] = a / scale[t]
        for t in range(n - 2, -1, -1):
            beta[t] = (pe[t + 1] * beta[t + 1]) @ pt.T / scale[t + 1]
        return alpha, beta, scale, pe, pt, top

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood of the tag sequences ``y`` and its gradients."""
        e, (both, ka, kb) = self.emissions(x)
        tr, width = self._transitions(), x.shape[1]
        alpha, beta, scale, pe, pt, top = self._sums(e)
        after = pe[1:] * beta[1:] / scale[1:]
        dt = pt * (alpha[:-1].reshape(-1, _TAGS).T @ after.reshape(-1, _TAGS))
        gold = np.take_along_axis(e, y[:, :, None], 2).sum() + tr[y[:-1], y[1:]].sum() + self._first[y[0]].sum()
        loss = (np.log(scale).sum() + top.sum() - gold) / width
        known = np.eye(_TAGS)[y]
        de = (alpha * beta - known) / width
        dt = np.where(self.barred, 0, (dt - known[:-1].reshape(-1, _TAGS).T @ known[1:].reshape(-1, _TAGS)) / width)
        grads = {"w": both.reshape(-1, 2 * self.h).T @ de.reshape(-1, _TAGS), "e": de.sum((0, 1)), "t": dt}
        dboth = de @ self.p["w"].T
        self._back(x, ka, dboth[:, :, : self.h], "f", grads)
        self._back(x[::-1], kb, dboth[::-1, :, self.h :], "b", grads)
        return float(loss), grads

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tag sequences, and the probability of the tag chosen for each character."""
        e, _ = self.emissions(x)
        tr, n = self._transitions(), len(x)
        score = e[0] + self._first
        come = np.empty(e.shape, np.int8)
        for t in range(1, n):
            through = score[:, :, None] + tr
            come[t] = through.argmax(1)
            score = through.max(1) + e[t]
        tags = np.empty(x.shape, np.int8)
        tags[-1] = score.argmax(1)
        rows = np.arange(x.shape[1])
        for t in range(n - 1, 0, -1):
            tags[t - 1] = come[t, rows, tags[t]]
        alpha, beta, *_ = self._sums(e)
        return tags, np.take_along_axis(alpha * beta, tags[:, :, None].astype(int), 2)[:, :, 0]


def window_starts(text: str, how: PiiModel) -> list[int]:
    """Windows ``stride`` apart that cover every @ and digit and the characters around them."""
    near, starts, upto = how.window - how.stride, [], -1
    for m in re.finditer("[0-9@]+", text):
        lo, hi = max(0, m.start() - near), m.end() + near
        at = max(lo // how.stride * how.stride, upto + 1 if upto >= 0 else 0)
        at = -(-at // how.stride) * how.stride if at > lo else at
        while at < min(hi, len(text)):
            if at > upto:
                starts.append(at)
                upto = at
            at += how.stride
    return starts


def _coded(pieces: list[str], size: int) -> np.ndarray:
    x = np.zeros((size, len(pieces)), np.int64)
    for i, piece in enumerate(pieces):
        x[: len(piece), i] = [_symbol(c) for c in piece]
    return x


def _rewritten(text: str, spans: list[Span], rng: np.random.Generator) -> tuple[str, list[Span]]:
    """The text with some spans in another form that the patterns don't know, and the spans there."""
    out, moved, at = [], [], 0
    for kind, start, end in sorted(spans, key=lambda s: s[1]):
        if start < at:
            continue
        value = text[start:end]
        form = int(rng.integers(0, 3))
        if kind == "phone" and form:
            bare = re.sub(r"^\+[0-9]{1,3}[ .-]?", "", value) or value
            value = bare if form == 1 else re.sub(r"[ ()]+", "-", bare).strip("-")
        elif kind == "email" and form == 1:
            value = value.replace("@", " @ ")
        elif kind == "card" and form:
            value = " ".join(value[i : i + 4] for i in range(0, len(value), 4)) if value.isdigit() else value
            value = value.replace(" ", ". " if form == 2 else " ")
        out.append(text[at:start])
        begin = sum(map(len, out))
        out.append(value)
        moved.append((kind, begin, begin + len(value)))
        at = end
    return "".join(out) + text[at:], moved


def train(samples: list[str], how: PiiModel) -> Tagger:
    """Fits a tagger to the labelled spans of ``samples`` and to rewritten forms of them."""
    rng, model = np.random.default_rng(how.seed), Tagger(how)
    pieces, tags = [], []
    for text in samples:
        spans = base_spans(text)
        for version in range(3):
            body, named = (text, spans) if version == 0 else _rewritten(text, spans, rng)
            marks = np.zeros(len(body), np.int64)
            for kind, start, end in named:
                marks[start:end] = 2 * KINDS.index(kind) + 2
                marks[start] = 2 * KINDS.index(kind) + 1
            for at in window_starts(body, how)[:12]:
                at = int(max(0, at + rng.integers(-8, 9)))
                piece = marks[at : at + how.window].copy()
                if len(piece) and piece[0] and piece[0] % 2 == 0:
                    piece[0] -= 1  # a span that began before the window
                pieces.append(body[at : at + how.window])
                tags.append(piece)
    if not pieces:
        return model
    x = _coded(pieces, how.window)
    y = np.zeros_like(x)
    for i, piece in enumerate(tags):
        y[: len(piece), i] = piece
    m, v = ({k: np.zeros_like(a) for k, a in model.p.items()} for _ in range(2))
    for step in range(1, how.steps + 1):
        pick = rng.integers(0, x.shape[1], how.batch)
        _, grads = model.loss(x[:, pick], y[:, pick])
        size = np.sqrt(sum((g * g).sum() for g in grads.values()))
        rate = how.rate * min(1, 2 * (1 - step / (how.steps + 1)))
        for k, g in grads.items():
            g = g * min(1, 5 / (size + 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            model.p[k] = model.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return model


@dataclass(frozen=True)
class _Piece:
    """A span of one decoded window, and whether the window's edge cuts it off."""

    start: int
    end: int
    kind: int
    sure: np.ndarray
    cut_left: bool
    cut_right: bool


def _pieces(tags: np.ndarray, sure: np.ndarray, start: int, size: int, whole: int) -> list[_Piece]:
    out, i = [], 0
    while i < size:
        if not tags[i]:
            i += 1
            continue
        kind, j = (tags[i] - 1) // 2, i + 1
        while j < size and tags[j] == 2 * kind + 2:
            j += 1
        out.append(_Piece(start + i, start + j, int(kind), sure[i:j].copy(), i == 0 and start > 0, j == size and start + size < whole))
        i = j
    return out


def _stitched(pieces: list[_Piece], least: float) -> list[tuple[int, int, str, float]]:
    """Proposals (start, end, kind, score): pieces that no edge cuts, and pieces of one kind that overlap or meet, joined where one is cut towards the other."""
    runs: list[list[_Piece]] = []
    for kind in range(len(KINDS)):
        end = open_end = -1  # of the run, and of its pieces that go on behind their window
        for p in sorted((p for p in pieces if p.kind == kind), key=lambda p: (p.start, p.end)):
            if p.start <= (end if p.cut_left else open_end):
                runs[-1].append(p)
            else:
                runs.append([p])
                end = open_end = -1
            end = max(end, p.end)
            open_end = max(open_end, p.end) if p.cut_right else open_end
    out = []
    for run in runs:
        for p in run:
            if not (p.cut_left or p.cut_right) and (mean := float(p.sure.mean())) >= least:
                out.append((p.start, p.end, KINDS[p.kind], mean * (p.end - p.start)))
        if len(run) > 1:
            start, end = run[0].start, max(p.end for p in run)
            sure = np.zeros(end - start)
            for p in run:
                part = sure[p.start - start : p.end - start]
                np.maximum(part, p.sure, out=part)
            if (mean := float(sure.mean())) >= least:
                out.append((start, end, KINDS[run[0].kind], mean * (end - start)))
    return out


def _missing(pieces: list[_Piece], starts: set[int], upto: int, how: PiiModel, reach: int) -> set[int]:
    """Starts of up to ``reach`` windows behind each cut that no decoded window looks across."""
    out, order = set(), sorted(starts)
    for p in pieces:
        if p.cut_left:
            i = int(np.searchsorted(order, p.start))
            if i == 0 or order[i - 1] + how.window <= p.start:
                out.update(max(0, p.start - k * how.stride) for k in range(1, reach + 1))
        if p.cut_right:
            i = int(np.searchsorted(order, p.end, side="right"))
            if order[i - 1] + how.window <= p.end:
                out.update(at for k in range(reach) if (at := p.end - how.window + (k + 1) * how.stride) < upto)
    return out - starts


def reconcile(proposals: list[tuple[int, int, str, float]]) -> list[Span]:
    """The proposals without overlaps that have the highest total score."""
    best = {}
    for start, end, kind, score in proposals:
        best[start, end, kind] = max(score, best.get((start, end, kind), 0))
    rows = sorted(((e, s, k, v) for (s, e, k), v in best.items()))
    ends = [r[0] for r in rows]
    total, take = [0.0] * (len(rows) + 1), [False] * len(rows)
    before = [int(np.searchsorted(ends, r[1], side="right")) for r in rows]
    for i, r in enumerate(rows):
        take[i] = r[3] + total[before[i]] > total[i]
        total[i + 1] = max(total[i], r[3] + total[before[i]])
    out, i = [], len(rows)
    while i:
        if take[i - 1]:
            e, s, k, _ = rows[i - 1]
            out.append((k, s, e))
            i = before[i - 1]
        else:
            i -= 1
    return out[::-1]


def plausible(kind: str, value: str) -> bool:
    """Whether a span that the model proposes can be of its kind at all."""
    digits = _digits(value)
    if "\n" in value:
        return False
    if kind == "email":
        return re.fullmatch(r"[A-Za-z0-9._%+-]+ ?@ ?[A-Za-z0-9-]+( ?\. ?[A-Za-z0-9-]+)+", value) is not None
    if kind == "ip":
        return re.fullmatch(r"[0-9]+( ?\. ?[0-9]+){3}", value) is not None and all(int(x) <= 255 for x in re.findall("[0-9]+", value))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and re.fullmatch(r"[0-9 .-]+", value) is not None
    return 10 <= len(digits) <= 15 and re.fullmatch(r"\+?[0-9 ().-]+", value) is not None and len(re.findall("[0-9]+", value)) > 1


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] in " .-":
        start += 1
    while end > start and text[end - 1] in " .-(":
        end -= 1
    return start, end


def _proposals(texts: list[str], model: Tagger, how: PiiModel, block: int) -> list[list[tuple[int, int, str, float]]]:
    """Proposals of each text. A span that is cut off where no further window lies gets windows there until it is whole."""
    starts = [set(window_starts(text, how)) for text in texts]
    found: list[list[_Piece]] = [[] for _ in texts]
    places, reach = [(i, at) for i in range(len(texts)) for at in sorted(starts[i])], 1
    while places:
        for k in range(0, len(places), block):
            part = places[k : k + block]
            tags, sure = model.decode(_coded([texts[i][at : at + how.window] for i, at in part], how.window))
            for column, (i, at) in enumerate(part):
                found[i].extend(_pieces(tags[:, column], sure[:, column], at, min(how.window, len(texts[i]) - at), len(texts[i])))
        more = {i: _missing(found[i], starts[i], len(texts[i]), how, reach) for i in sorted({i for i, _ in places})}
        places = [(i, at) for i, each in more.items() for at in sorted(each)]
        for i, each in more.items():
            starts[i] |= each
        reach *= 2
    return [_stitched(pieces, how.least_score) for pieces in found]


def find_spans(texts: list[str], model: Tagger, how: PiiModel, block: int = 2048) -> list[list[Span]]:
    """All spans of each text, by kind and start: those of the patterns, and those of the model that overlap none of them."""
    out = []
    for text, proposed in zip(texts, _proposals(texts, model, how, block), strict=True):
        spans = base_spans(text)
        taken = sorted((s, e) for _, s, e in spans)
        # what can't be of its kind takes no place from what can
        fit = [(s, e, k, v) for start, end, k, v in proposed for s, e in [_trimmed(text, start, end)] if plausible(k, text[s:e])]
        for kind, start, end in reconcile(fit):
            if not any(s < end and start < e for s, e in taken):
                spans.append((kind, start, end))
        out.append(sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))
    return out


def labelled_sample(docs: DataFrame, how: PiiModel) -> list[str]:
    """At most ``how.documents`` texts with an @ or a run of digits: those with the smallest hashes, from all documents."""
    text = F.col("text").cast("string")
    rows = docs.select(text.alias("text")).where(F.col("text").rlike(r"[0-9]\.[0-9]|[0-9]{7}|\+[0-9]|[A-Za-z0-9]@[A-Za-z0-9]"))
    # a text is cut to the surroundings of its first finds: the bound holds for bytes too
    around = F.regexp_extract_all("text", F.lit(r"(?s).{0,60}(?:[0-9]\.[0-9]|[0-9]{7}|\+[0-9]|[A-Za-z0-9]@[A-Za-z0-9]).{0,60}"), F.lit(0))
    # hashes first, so that no task sends texts that aren't picked; equal texts count once
    hashed = F.xxhash64("text")
    first = [r[0] for r in rows.select(hashed.alias("hash")).distinct().orderBy("hash").limit(how.documents).collect()]
    picked = rows.where(hashed.isin(first)).select(hashed.alias("hash"), F.slice(around, 1, 4).alias("pieces")).dropDuplicates(["hash"])
    return sorted(piece for r in picked.collect() for piece in r.pieces)


def learn(docs: DataFrame, how: PiiModel | None = None) -> Tagger:
    return train(labelled_sample(docs, how or PiiModel()), how or PiiModel())


def with_spans(docs: DataFrame, model: Tagger, how: PiiModel | None = None) -> DataFrame:
    """The rows of ``docs`` with ``base`` and ``spans``: arrays of struct(kind, start, end), code points, end exclusive.

    Null texts are empty and have none. All columns are kept; columns named
    like the new ones are replaced.
    """
    how = how or PiiModel()
    docs = docs.drop("base", "spans")
    others = docs.columns
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    spans = ArrayType(StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())]))
    schema = StructType([*docs.schema.fields, StructField("base", spans), StructField("spans", spans)])

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = lambda rows: pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in r] for r in rows], kind)
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column("text")]
            yield pa.record_batch([*(batch.column(c) for c in others), named([base_spans(t) for t in texts]), named(find_spans(texts, model, how))], names=[*others, "base", "spans"])

    return map_arrow(docs, tag, schema)


def pii_report(docs: DataFrame, how: PiiModel | None = None) -> DataFrame:
    """One row per document: doc_id, counts of base spans by kind, base_sha256, spans."""
    found = with_spans(docs.select("doc_id", "text"), learn(docs, how), how)
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def mask(docs: DataFrame, how: PiiModel | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; ``n_chars``, if there, is counted anew.

    Spans that overlap (an address inside a number, say) are replaced as one,
    by the kind of the first. Null texts stay null.
    """
    columns = docs.columns
    found = with_spans(docs, learn(docs, how), how)
    begin = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))

    def step(state, span):  # type: ignore[no-untyped-def]
        apart = span["start"] >= state["at"]
        added = F.concat(state["done"], F.substr(F.col("text"), (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int")), F.lit("<"), span["kind"], F.lit(">"))
        return F.struct(F.when(apart, added).otherwise(state["done"]).alias("done"), F.greatest(state["at"], span["end"]).alias("at"))

    by_start = F.array_sort("spans", lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(b["end"].cast("int") - a["end"].cast("int")))
    end = F.aggregate(by_start, begin, step)
    masked = F.concat(end["done"], F.substr(F.col("text"), (end["at"] + 1).cast("int"), F.length("text")))
    found = found.withColumn("text", F.when(F.size("spans") > 0, masked).otherwise(F.col("text")))
    if "n_chars" in columns:
        found = found.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return found.select(*columns)
