"""Personal data by rules and by a character-level bidirectional LSTM with CRF transitions (operator 5).

The rules find emails, IP addresses, payment cards and international phone numbers. Their spans label windows of text from
which the tagger is trained, together with other spellings of such values put in their place (a phone number without its
plus sign, a card number in dotted groups, an address in brackets). The tagger then adds spans that the rules miss.

Texts are cut into windows that overlap by half. Each window is decoded by itself (Viterbi); a character takes its tag from
the window in which it stands farthest from the edges, and spans are read from the tags of the whole text. A span must pass the
exact check of its kind, stand free of letters and digits, and touch no span found before. Every kind needs a digit or an
at sign, so a span wholly inside windows without one would fail its check: such windows count as outside and are not computed.

Defined results: a null text counts as empty and has no spans; without any labelled span there is no tagger and the rules
alone decide; repeated rows are scanned as often as they occur; columns beside key and text are not looked at.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listmill.llm.arrays import small_batches

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

# Rows that labelled windows are looked for in, on average, and windows of each kind that the tagger is trained from.
SAMPLE_ROWS = 20_000
WINDOWS_PER_KIND = 256
WINDOW, STRIDE, HIDDEN, EPOCHS, BATCH, RATE = 64, 32, 16, 10, 64, 0.02

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A longer run of digits is one number: a match that starts inside it would end where one from its start ends.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+(?<=[0-9])")
_TRIGGER = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, not overlapping. Goes from one at sign to the next, so that a long word costs its length once."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            out.append((start, end))
        at = text.find("@", at + 1)
    return out


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind, start and end of what the rules find, by kind and start."""
    out = [(EMAIL, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((IP, *m.span()))
    for m in _CARD.finditer(text):
        digits = only_digits(m.group()) if m.end() - m.start() <= 64 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((CARD, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                out.append((PHONE, *m.span()))
    return out


# ---------------------------------------------------------------- characters and tags

# Classes of characters: padding, digits, letters, a class for each of some signs, all else.
_SIGNS = "@.-+ ()[]:_/%#\n\"=,"
PAD, LOW, MIDDLE, HIGH, SMALL, LARGE, FOREIGN, OTHER = range(8)
CLASSES = 8 + len(_SIGNS)
# Tag 0 is outside; kind k begins with 1 + 2 * k and goes on with 2 + 2 * k.
TAGS = 1 + 2 * len(KINDS)


@cache
def _classes() -> np.ndarray:
    """The class of every code point below 0x300; letters beyond ASCII are foreign."""
    table = np.full(0x300, OTHER, np.uint8)
    table[0xC0:0x300] = FOREIGN
    for c in "012":
        table[ord(c)] = LOW
    for c in "3456":
        table[ord(c)] = MIDDLE
    for c in "789":
        table[ord(c)] = HIGH
    table[97:123], table[65:91] = SMALL, LARGE
    for k, c in enumerate(_SIGNS):
        table[ord(c)] = 8 + k
    return table


def classes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 0x300, _classes()[np.minimum(points, 0x2FF)], FOREIGN).astype(np.uint8)


def _allowed() -> np.ndarray:
    """0 where a tag may follow another, else a large negative number: a kind goes on only where it stands."""
    out = np.zeros((TAGS, TAGS), np.float32)
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        for before in range(TAGS):
            if before not in (inside, inside - 1):
                out[before, inside] = -1e4
    return out


# ---------------------------------------------------------------- the tagger


def _sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Tagger:
    """Weights of the network; ``train`` fits them, ``decode`` gives the best tags of windows."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        h = HIDDEN
        self.w = {}
        for side in "fb":
            self.w[f"x{side}"] = r.normal(0, 0.3, (CLASSES, 4 * h)).astype(np.float32)
            self.w[f"x{side}"][:, h : 2 * h] += 1  # remember at first
            self.w[f"h{side}"] = r.normal(0, 0.2, (h, 4 * h)).astype(np.float32)
        self.w["out"] = r.normal(0, 0.2, (2 * h, TAGS)).astype(np.float32)
        self.w["bias"] = np.zeros(TAGS, np.float32)
        self.w["next"] = np.zeros((TAGS, TAGS), np.float32)
        self.w["first"] = np.zeros(TAGS, np.float32)

    def _lstm(self, codes: np.ndarray, side: str, keep: bool):
        """Hidden states (steps, rows, hidden) of one direction; with ``keep`` also what training needs."""
        steps, rows = codes.shape
        h = np.zeros((rows, HIDDEN), np.float32)
        c = np.zeros((rows, HIDDEN), np.float32)
        out = np.empty((steps, rows, HIDDEN), np.float32)
        kept = []
        x, u = self.w[f"x{side}"], self.w[f"h{side}"]
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = x[codes[t]] + h @ u
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            g = np.tanh(z[:, 3 * HIDDEN :])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            before = (h, c)
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            if keep:
                kept.append((t, before, i, f, o, g, tc))
        return out, kept

    def _lstm_back(self, codes, side, kept, d_out, grad):
        rows = codes.shape[1]
        dh = np.zeros((rows, HIDDEN), np.float32)
        dc = np.zeros((rows, HIDDEN), np.float32)
        u = self.w[f"h{side}"]
        for t, (h, c), i, f, o, g, tc in reversed(kept):
            dh = dh + d_out[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            np.add.at(grad[f"x{side}"], codes[t], dz)
            grad[f"h{side}"] += h.T @ dz
            dh = dz @ u.T
            dc = dc * f

    def _scores(self, codes, keep=False):
        ahead, kept_f = self._lstm(codes, "f", keep)
        back, kept_b = self._lstm(codes, "b", keep)
        hidden = np.concatenate([ahead, back], axis=2)
        return hidden @ self.w["out"] + self.w["bias"], hidden, kept_f, kept_b

    def _loss(self, codes: np.ndarray, tags: np.ndarray):
        """Mean negative log likelihood of the tags (steps, rows) and its gradient."""
        steps, rows = codes.shape
        scores, hidden, kept_f, kept_b = self._scores(codes, keep=True)
        step = self.w["next"] + _allowed()

        def soft(x, axis):
            top = x.max(axis=axis, keepdims=True)
            return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))

        alpha = np.empty_like(scores)
        beta = np.zeros_like(scores)
        alpha[0] = scores[0] + self.w["first"]
        for t in range(1, steps):
            alpha[t] = scores[t] + soft(alpha[t - 1][:, :, None] + step[None], 1)
        for t in range(steps - 2, -1, -1):
            beta[t] = soft(step[None] + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
        total = soft(alpha[-1], 1)
        grad = {k: np.zeros_like(v) for k, v in self.w.items()}
        d_scores = np.exp(alpha + beta - total[None, :, None])
        grad["first"] = d_scores[0].sum(axis=0)
        index = np.arange(rows)
        gold = scores[0, index, tags[0]] + self.w["first"][tags[0]]
        np.add.at(grad["first"], tags[0], -1)
        for t in range(1, steps):
            pair = alpha[t - 1][:, :, None] + step[None] + (scores[t] + beta[t])[:, None, :] - total[:, None, None]
            grad["next"] += np.exp(pair).sum(axis=0)
            np.add.at(grad["next"], (tags[t - 1], tags[t]), -1)
            gold = gold + scores[t, index, tags[t]] + step[tags[t - 1], tags[t]]
        d_scores[np.arange(steps)[:, None], index[None], tags] -= 1
        grad["out"] = hidden.reshape(-1, 2 * HIDDEN).T @ d_scores.reshape(-1, TAGS)
        grad["bias"] = d_scores.sum(axis=(0, 1))
        d_hidden = d_scores @ self.w["out"].T
        self._lstm_back(codes, "f", kept_f, d_hidden[:, :, :HIDDEN], grad)
        self._lstm_back(codes, "b", kept_b, d_hidden[:, :, HIDDEN:], grad)
        return float((total - gold).mean()), {k: v / rows for k, v in grad.items()}

    def train(self, codes: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> list[float]:
        """Fit to windows (rows, steps) by Adam; returns the loss after each epoch."""
        r = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        losses, n = [], 0
        for _ in range(epochs):
            order, part = r.permutation(len(codes)), []
            for low in range(0, len(order), BATCH):
                rows = order[low : low + BATCH]
                loss, grad = self._loss(codes[rows].T, tags[rows].T)
                part.append(loss)
                n += 1
                scale = min(1.0, 5.0 / (1e-9 + np.sqrt(sum(float((g * g).sum()) for g in grad.values()))))
                for k, g in grad.items():
                    g = g * scale
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    self.w[k] -= RATE * (first[k] / (1 - 0.9**n)) / (np.sqrt(second[k] / (1 - 0.99**n)) + 1e-7)
            losses.append(float(np.mean(part)))
        return losses

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The best tags of windows (rows, steps)."""
        scores = self._scores(codes.T)[0]
        step = self.w["next"] + _allowed()
        steps, rows, _ = scores.shape
        back = np.empty((steps, rows, TAGS), np.uint8)
        best = scores[0] + self.w["first"]
        for t in range(1, steps):
            paths = best[:, :, None] + step[None]
            back[t] = paths.argmax(axis=1)
            best = paths.max(axis=1) + scores[t]
        out = np.empty((rows, steps), np.uint8)
        out[:, -1] = best.argmax(axis=1)
        index = np.arange(rows)
        for t in range(steps - 1, 0, -1):
            out[:, t - 1] = back[t, index, out[:, t]]
        return out


# ---------------------------------------------------------------- windows


def windows_of(text: str, triggers: list[int]) -> list[int]:
    """Starts of the windows that hold a trigger, of the grid that covers the text."""
    last = max(0, -(-(len(text) - WINDOW) // STRIDE))
    found = set()
    for at in triggers:
        for k in (at // STRIDE - 1, at // STRIDE):
            if 0 <= k <= last:
                found.add(k * STRIDE)
        if at // STRIDE > last:
            found.add(last * STRIDE)
    return sorted(found)


def window_codes(codes: np.ndarray, start: int) -> np.ndarray:
    part = codes[start : start + WINDOW]
    return part if len(part) == WINDOW else np.concatenate([part, np.full(WINDOW - len(part), PAD, np.uint8)])


def stitch(length: int, starts: list[int], tags: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans of a text: each character has the tag of the window in which it is farthest from an edge."""
    out, quarter = [], STRIDE // 2
    last = max(0, -(-(length - WINDOW) // STRIDE)) * STRIDE
    kind = start = end = -1
    for row, at in enumerate(starts):
        low = at if at == 0 else at + quarter
        high = min(length, at + WINDOW if at == last else at + WINDOW - quarter)
        line = tags[row, low - at : high - at]
        if not line.any() and kind < 0:
            continue
        if kind >= 0 and low > end:
            out.append((kind, start, end))
            kind = -1
        for p, tag in enumerate(line.tolist(), start=low):
            own = (tag - 1) // 2 if tag else -1
            if own < 0 or own != kind or tag % 2:
                if kind >= 0:
                    out.append((kind, start, end))
                kind, start = own, p
            if own >= 0:
                end = p + 1
    if kind >= 0:
        out.append((kind, start, end))
    return out


def accept(text: str, kind: int, start: int, end: int) -> bool:
    """The exact check of a tagged span."""
    while start < end and not text[start].isalnum() and text[start] not in "(+":
        start += 1
    part = text[start:end]
    if not part or (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum()):
        return False
    digits = only_digits(part)
    if kind == EMAIL:
        name, sign, domain = part.partition("@")
        return bool(sign) and bool(re.search(r"\w", name)) and bool(re.fullmatch(r"[\w-]+(\.[\w-]+)+", domain.strip("[]() ")))
    if kind == IP:
        parts = re.split(r"[^0-9]+", part.strip("[]() "))
        return len(parts) == 4 and all(p and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == CARD:
        return 13 <= len(digits) <= 19 and luhn(digits) and not re.search(r"[^0-9 .-]", part)
    groups = re.findall(r"[0-9]+", part)
    return 8 <= len(digits) <= 15 and len(groups) >= 3 and max(map(len, groups)) <= 5 and not re.search(r"[^0-9 ().+/-]", part)


def add_spans(text: str, base: list[tuple[int, int, int]], tagged: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The rules' spans and, of the tagged ones, those that pass their check and touch no other."""
    out = list(base)
    # what is taken, as stretches that do not meet, in order
    starts, ends = [], []
    for low, high in sorted((a, b) for _, a, b in base):
        if ends and low < ends[-1]:
            ends[-1] = max(ends[-1], high)
        else:
            starts.append(low), ends.append(high)
    for kind, start, end in tagged:
        at = bisect_right(ends, start)
        if (at == len(starts) or end <= starts[at]) and accept(text, kind, start, end):
            out.append((kind, start, end))
            starts.insert(at, start), ends.insert(at, end)
    return sorted(out)


# ---------------------------------------------------------------- training data


def labelled_windows(text: str) -> list[tuple[int, str, int, int]]:
    """Kind, text of a window around each span, and the span in it."""
    out = []
    for kind, start, end in rule_spans(text):
        if end - start <= 40:
            low = max(0, start - 12)
            out.append((kind, text[low : low + WINDOW], start - low, end - low))
    return out


def _other(kind: int, value: str, r: random.Random) -> str:
    """Another value of the kind, sometimes in a spelling that the rules do not know."""
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    if kind == EMAIL:
        name, _, domain = value.partition("@")
        return r.choice([f"{name}{d(2)}@{domain}", f"{name}@[{domain}]", f"{name}'s@{domain}"])
    if kind == IP:
        parts = [str(r.randrange(256)) for _ in range(4)]
        return r.choice([".", ".", "-", " . "]).join(parts)
    if kind == CARD:
        n = r.choice([14, 15, 15])
        body = d(n)
        check = next(c for c in "0123456789" if luhn(body + c))
        digits = body + check
        return r.choice(["", "."]).join(digits[k : k + 4] for k in range(0, len(digits), 4))
    a, b, c = r.randrange(200, 990), r.randrange(200, 990), r.randrange(10**4)
    return r.choice([f"({a}) {b}-{c:04d}", f"{a}-{b}-{c:04d}", f"{a}.{b}.{c:04d}", f"1 ({a}) {b}-{c:04d}", f"+{r.randrange(1, 90)} {a} {b} {c:04d}"])


def _plain(r: random.Random) -> str:
    """Digits that are no personal data."""
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    return r.choice([d(r.randrange(1, 5)), f"{d(1)}.{d(1)}", "".join(r.choice("0123456789abcdef") for _ in range(32)), f"{d(1)},{d(3)}", f"20{d(2)}-{d(2)}-{d(2)}", d(12)])


def training_set(rows: list[tuple[int, str, int, int]], seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Classes and tags of the labelled windows, of as many with another spelling, and of as many without any span."""
    r = random.Random(seed)
    codes, tags = [], []

    def add(text: str, kind: int | None, start: int = 0, end: int = 0):
        line = np.zeros(WINDOW, np.int64)
        if kind is not None:
            end = min(end, WINDOW)
            line[start:end] = 2 + 2 * kind
            line[start] = 1 + 2 * kind
        codes.append(window_codes(classes_of(text[:WINDOW]), 0))
        tags.append(line)

    for kind, text, start, end in rows:
        # another span in the window would be tagged as outside: such a window is only used with its value replaced
        before, after = text[:start], text[end:]
        clear = not _TRIGGER.search(before) and not _TRIGGER.search(after)
        before, after = _TRIGGER.sub("a", before), _TRIGGER.sub("a", after)
        if clear:
            add(text, kind, start, end)
        value = _other(kind, text[start:end], r)
        add(before + value + after, kind, start, start + len(value))
        add(before + _plain(r) + after, None)
    return np.array(codes), np.array(tags)


def learn(df: DataFrame, key: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS, windows: int = WINDOWS_PER_KIND) -> Tagger | None:
    """A tagger trained from the rules' spans in a sample of about ``rows`` rows, chosen by a hash of the key."""
    total = df.count()
    if not total:
        return None
    share = int(min(1.0, rows / total) * (1 << 20))
    chance = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 20))
    picked = small_batches(df).filter((chance < share) & F.col(text).rlike("[0-9@]")).select(chance.alias("place"), F.col(text).alias("text"))
    schema = "kind int, place long, text string, first int, last int"

    def task(batches):
        for batch in batches:
            found = [
                (k, p, t, a, b)
                for p, value in zip(batch.column("place").to_pylist(), batch.column("text").to_pylist(), strict=True)
                for k, t, a, b in labelled_windows(value)
            ]
            columns = list(zip(*found, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()),
                 pa.array(columns[3], pa.int32()), pa.array(columns[4], pa.int32())],
                names=["kind", "place", "text", "first", "last"],
            )

    order = Window.partitionBy("kind").orderBy("place", "text", "first")
    found = picked.mapInArrow(task, schema).withColumn("n", F.row_number().over(order)).filter(F.col("n") <= windows)
    labelled = [(r["kind"], r["text"], r["first"], r["last"]) for r in found.orderBy("kind", "n").collect()]
    if not labelled:
        return None
    tagger = Tagger()
    tagger.losses = tagger.train(*training_set(labelled))
    return tagger


# ---------------------------------------------------------------- the operator

_ROWS = 2048  # windows decoded together
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _tagged(tagger: Tagger, texts: list[str], which: list[int]) -> dict[int, list[tuple[int, int, int]]]:
    """Spans that the tagger sees in the chosen texts."""
    starts, codes = {}, []
    for k in which:
        starts[k] = windows_of(texts[k], [m.start() for m in _TRIGGER.finditer(texts[k])])
        whole = classes_of(texts[k])
        codes += [window_codes(whole, s) for s in starts[k]]
    if not codes:
        return {}
    grid = np.array(codes)
    tags = np.concatenate([tagger.decode(grid[a : a + _ROWS]) for a in range(0, len(grid), _ROWS)])
    out, low = {}, 0
    for k in which:
        out[k] = stitch(len(texts[k]), starts[k], tags[low : low + len(starts[k])])
        low += len(starts[k])
    return out


def find(df: DataFrame, tagger: Tagger | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, the rules' spans and all spans of each text, as arrays of (kind, start, end) in code points."""
    sent = df.sparkSession.sparkContext.broadcast(tagger)
    narrow = small_batches(df).select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([narrow.schema["key"], T.StructField("base", span), T.StructField("spans", span)])
    named = lambda rows: [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in rows]

    def task(batches):
        own = sent.value
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            which = [k for k, t in enumerate(texts) if _TRIGGER.search(t)]
            base = {k: rule_spans(texts[k]) for k in which}
            tagged = _tagged(own, texts, which) if own else {}
            every = {k: add_spans(texts[k], base[k], tagged.get(k, [])) for k in which}
            arrays = [
                batch.column("key"),
                pa.array([named(base.get(k, [])) for k in range(len(texts))], _SPAN),
                pa.array([named(every.get(k, [])) for k in range(len(texts))], _SPAN),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return narrow.mapInArrow(task, schema).withColumnRenamed("key", key)


def written(spans: str):
    """kind:start:end of all spans, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def report(docs: DataFrame) -> DataFrame:
    """doc_id, number of base spans of each kind, their digest, and all spans as text."""
    found = find(docs, learn(docs))

    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(number, KINDS),
        F.sha2(written("base").cast("binary"), 256).alias("base_sha256"),
        written("spans").alias("spans"),
    )


def mask(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with every span replaced by its kind in angle brackets; other columns and their order stay."""
    tagger = learn(docs, key, text)
    sent = docs.sparkSession.sparkContext.broadcast(tagger)
    columns, schema = docs.columns, docs.schema

    def task(batches):
        own = sent.value
        for batch in batches:
            values = batch.column(columns.index(text)).to_pylist()
            texts = [t or "" for t in values]
            which = [k for k, t in enumerate(texts) if _TRIGGER.search(t)]
            tagged = _tagged(own, texts, which) if own else {}
            for k in which:
                parts, end = [], 0
                for kind, a, b in sorted(add_spans(texts[k], rule_spans(texts[k]), tagged.get(k, [])), key=lambda s: s[1:]):
                    if a >= end:
                        parts += [texts[k][end:a], f"<{KINDS[kind]}>"]
                    end = max(end, b)
                values[k] = "".join([*parts, texts[k][end:]])
            arrays = [pa.array(values, batch.schema.field(n).type) if n == columns.index(text) else batch.column(n) for n in range(len(columns))]
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return small_batches(docs).mapInArrow(task, schema)
