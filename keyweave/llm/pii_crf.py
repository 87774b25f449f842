"""Personal data: exact patterns, and spans that a linear-chain conditional random field adds.

Tokens are runs without ASCII white space. The field sees word shapes only: shape and number of digits of a token, shapes
of its neighbours. A token with neither digit nor ``@`` can only be outside, so a text's best tag sequence falls apart
into runs of the other tokens, and only these are decoded: Viterbi over all runs of a batch at once.
The field is trained on the driver from ``labelled_table``, a few hundred short sentences made by rule.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyweave.llm.shared import map_rows

KINDS = ("email", "ip", "card", "phone")
TAGS = ("O", *(f"{b}-{k}" for k in KINDS for b in "BI"))
WHITE = " \t\n\v\f\r"

#: The patterns of the base spans.
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
EVIDENCE = re.compile("[0-9@]")
TO_WHITE = re.compile(r"[^\x20\x09-\x0D]*")


def _digits(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def luhn(text: str) -> bool:
    digits = _digits(text)[::-1]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _is_ip(text: str) -> bool:
    parts = text.split(".")
    return len(parts) == 4 and all(p.isascii() and p.isdigit() and _byte(p) for p in parts)


def _is_card(text: str) -> bool:
    return 14 <= len(_digits(text)) <= 19 and luhn(text)


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the patterns: leftmost, without overlap within a kind; a match that fails its check is dropped.

    An address is looked for around its ``@``, and an IP address only where a run of digits begins: the same matches
    as by search from the left, without rescanning a long run from each of its letters.
    """
    found = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        domain = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            found.append((start, "email", free))
        at = text.find("@", max(at + 1, free))
    for m in IP.finditer(text):
        if all(map(_byte, m.group().split("."))):
            found.append((m.start(), "ip", m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and _is_card(m.group()):
            found.append((m.start(), "card", m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(_digits(m.group())) <= 15:
                found.append((m.start(), "phone", m.end()))
    return in_order(found)


def in_order(spans: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def written(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


_UPPER, _LOWER, _NUMBER = re.compile(r"[A-Z]+"), re.compile(r"[^\W\d_A-Z]+"), re.compile(r"[0-9]+")


def shape(token: str) -> str:
    """Runs of capitals, other letters and digits as A, a and 9."""
    return _UPPER.sub("A", _LOWER.sub("a", _NUMBER.sub("9", token)))


def runs(text: str) -> list[list[tuple[int, int]]]:
    """Neighbouring tokens (start, end) that hold a digit or ``@``."""
    out: list[list[tuple[int, int]]] = []
    last = 0
    m = EVIDENCE.search(text)
    while m:
        start = m.start()
        while start > last and text[start - 1] not in WHITE:
            start -= 1
        end = TO_WHITE.match(text, m.end()).end()
        if out and not text[last:start].strip(WHITE):
            out[-1].append((start, end))
        else:
            out.append([(start, end)])
        last = end
        m = EVIDENCE.search(text, end)
    return out


def _before(text: str, at: int) -> str:
    while at and text[at - 1] in WHITE:
        at -= 1
    end = at
    while at and text[at - 1] not in WHITE:
        at -= 1
    return text[at:end]


def _after(text: str, at: int) -> str:
    while at < len(text) and text[at] in WHITE:
        at += 1
    return TO_WHITE.match(text, at).group()


def run_features(text: str, run: list[tuple[int, int]]) -> list[tuple[str, ...]]:
    """Features of each token of a run."""
    tokens = [text[a:b] for a, b in run]
    shapes = [shape(_before(text, run[0][0])), *map(shape, tokens), shape(_after(text, run[-1][1]))]
    return [(f"s={shapes[i + 1]}", f"p={shapes[i]}", f"n={shapes[i + 2]}", f"d={min(len(_digits(t)), 20)}", f"@={'@' in t}")
            for i, t in enumerate(tokens)]


_B, _I = {k: TAGS.index(f"B-{k}") for k in KINDS}, {k: TAGS.index(f"I-{k}") for k in KINDS}
#: What no tag sequence does: an inner tag after anything but its own kind, or at the start of a run.
FORBIDDEN = np.zeros((len(TAGS), len(TAGS)))
FORBIDDEN_START = np.zeros(len(TAGS))
for _k in KINDS:
    FORBIDDEN[:, _I[_k]] = -1e4
    FORBIDDEN[[_B[_k], _I[_k]], _I[_k]] = 0
    FORBIDDEN_START[_I[_k]] = -1e4


def labelled_table(n: int = 600, seed: int = 7) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Sentences with their spans (start, end, kind): addresses, numbers and look-alikes that are none, among words."""
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdefghilmnoprstu"), rng.integers(1, 9)))
    num = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    hexa = lambda k: "".join(rng.choice(list("0123456789abcdef"), k))

    def card() -> str:
        digits = str(rng.integers(3, 7)) + num(14)
        last = next(c for c in "0123456789" if luhn(digits + c))
        digits += last
        return rng.choice([digits, " ".join(digits[i:i + 4] for i in range(0, 16, 4)), "-".join(digits[i:i + 4] for i in range(0, 16, 4))])

    def octets() -> str:
        return ".".join(str(x) for x in rng.integers(0, 256, 4))

    make = {
        "email": [lambda: f"{word()}.{num(2)}@{word()}{num(1)}.example.com", lambda: f"{word()}@{word()}.org", lambda: f"{word()}_{word()}@{word()}.{word()}.net",
                  lambda: f"{word()}{num(2)}@localhost", lambda: f"{word()}@{word()}"],
        "ip": [octets],
        "card": [card],
        "phone": [lambda: f"+{num(1)} ({num(3)}) {num(3)}-{num(4)}", lambda: f"({num(3)}) {num(3)}-{num(4)}", lambda: f"{num(3)}-{num(3)}-{num(4)}",
                  lambda: f"+{num(2)} {num(2)} {num(4)} {num(4)}", lambda: f"{num(3)}.{num(3)}.{num(4)}", lambda: f"+{num(11)}"],
        "": [lambda: num(int(rng.integers(1, 6))), lambda: f"{num(1)}.{num(1)}", lambda: f"{num(1)}.", lambda: f"password={hexa(18)}", lambda: f'"{hexa(40)}"',
             lambda: f"AKIA{hexa(16).upper()}", lambda: f"v{num(1)}.{num(1)}.{num(1)}", lambda: f"20{num(2)}-{num(2)}-{num(2)}", lambda: f"{num(2)}:{num(2)}",
             lambda: f"({num(1)})", lambda: f"{num(1)},{num(3)}", lambda: f"{num(2)}%", lambda: f"${num(2)}.{num(2)}", lambda: f"{num(2)}-{num(2)}", lambda: f"@{word()}",
             lambda: hexa(12), lambda: num(int(rng.integers(6, 13))), lambda: f"{num(3)} {num(3)}", lambda: f"{word()}{num(2)}"],
    }
    table = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(rng.integers(2, 5)):
            text += " ".join(word() for _ in range(rng.integers(0, 4))) + " "
            kind = rng.choice(["email", "ip", "card", "phone", "", ""])
            entity = str(make[kind][rng.integers(len(make[kind]))]())
            if kind:
                spans.append((len(text), len(text) + len(entity), kind))
            text += entity + str(rng.choice(["", "", "", ".", ","])) + " "
        table.append((text + word(), spans))
    return table


class Field:
    """Weights of the field; ``emissions`` are remembered by feature tuple."""

    def __init__(self, names: dict[str, int], emit: np.ndarray, move: np.ndarray, start: np.ndarray):
        self.names, self.emit, self.move, self.start = names, emit, move, start

    def decode(self, sequences: list[list[tuple[str, ...]]], cells: int = 1 << 16) -> list[np.ndarray]:
        """Best tags of each sequence: Viterbi over batches of sequences of similar length."""
        known: dict[tuple, np.ndarray] = {}
        order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
        out: list = [None] * len(sequences)
        i = 0
        while i < len(order):
            n = 1
            while i + n < len(order) and (n + 1) * len(sequences[order[i + n]]) <= cells:
                n += 1
            chosen = order[i:i + n]
            longest = len(sequences[chosen[-1]])
            scores = np.zeros((n, longest, len(TAGS)))
            lengths = np.array([len(sequences[j]) for j in chosen])
            for row, j in enumerate(chosen):
                for t, features in enumerate(sequences[j]):
                    if features not in known:
                        if len(known) > 100_000:
                            known.clear()
                        known[features] = self.emit[[self.names[f] for f in features if f in self.names]].sum(axis=0)
                    scores[row, t] = known[features]
            for j, tags in zip(chosen, self._viterbi(scores, lengths)):
                out[j] = tags
            i += n
        return out

    def _viterbi(self, scores: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        n, longest, _ = scores.shape
        move = self.move + FORBIDDEN
        best = self.start + FORBIDDEN_START + scores[:, 0]
        final = best.copy()
        back = np.zeros((longest, n, len(TAGS)), dtype=np.int8)
        for t in range(1, longest):
            through = best[:, :, None] + move
            back[t] = through.argmax(axis=1)
            best = through.max(axis=1) + scores[:, t]
            live = lengths > t
            final[live] = best[live]
        tag = final.argmax(axis=1)
        tags = np.zeros((n, longest), dtype=np.int8)
        rows = np.arange(n)
        for t in range(longest - 1, -1, -1):
            inside = lengths > t
            tags[inside, t] = tag[inside]
            tag = np.where(inside & (t > 0), back[t][rows, tag], tag)
        return [tags[i, :lengths[i]] for i in range(n)]


def train(table: list[tuple[str, list[tuple[int, int, str]]]], steps: int = 120, rate: float = 0.2, penalty: float = 1e-3) -> Field:
    """Maximum likelihood by forward-backward over padded runs, Adam, fixed start: the same table gives the same field."""
    features, gold = [], []
    for text, spans in table:
        for run in runs(text):
            features.append(run_features(text, run))
            tags = []
            for a, b in run:
                kind = next(((s, k) for s, e, k in spans if s < b and a < e), None)
                tags.append(0 if kind is None else (_B if a <= kind[0] else _I)[kind[1]])
            gold.append(tags)
    names = {f: i for i, f in enumerate(sorted({f for run in features for token in run for f in token}))}
    n, longest, k = len(gold), max(map(len, gold)), len(TAGS)
    index = np.full((n, longest, 5), len(names))
    y, live = np.zeros((n, longest), dtype=int), np.zeros((n, longest), dtype=bool)
    for i, (run, tags) in enumerate(zip(features, gold)):
        for t, token in enumerate(run):
            index[i, t] = [names[f] for f in token]
        y[i, :len(tags)], live[i, :len(tags)] = tags, True
    rows = np.arange(n)
    parts = [np.zeros((len(names) + 1, k)), np.zeros((k, k)), np.zeros(k)]
    mean, square = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]

    def logsum(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for step in range(1, steps + 1):
        emit, move, start = parts
        scores, moves, first = emit[index].sum(axis=2), move + FORBIDDEN, start + FORBIDDEN_START
        alpha, beta = np.zeros((n, longest, k)), np.zeros((n, longest, k))
        alpha[:, 0] = first + scores[:, 0]
        for t in range(1, longest):
            alpha[:, t] = np.where(live[:, t, None], logsum(alpha[:, t - 1, :, None] + moves, 1) + scores[:, t], alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            beta[:, t] = np.where(live[:, t + 1, None], logsum(moves + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], 2), 0)
        z = logsum(alpha[:, -1], 1)
        marginal = np.exp(alpha + beta - z[:, None, None]) * live[:, :, None]
        error = marginal.copy()
        for t in range(longest):
            error[rows, t, y[:, t]] -= live[:, t]
        grads = [np.zeros_like(emit), np.zeros_like(move), error[:, 0].sum(axis=0)]
        np.add.at(grads[0], index.reshape(-1), np.repeat(error.reshape(-1, k), index.shape[2], axis=0))
        for t in range(1, longest):
            pair = np.exp(alpha[:, t - 1, :, None] + moves + (scores[:, t] + beta[:, t])[:, None, :] - z[:, None, None])
            pair *= live[:, t, None, None]
            grads[1] += pair.sum(axis=0)
            np.add.at(grads[1], (y[live[:, t], t - 1], y[live[:, t], t]), -1.0)
        for p, g, m, s in zip(parts, grads, mean, square):
            g = g / n + penalty * p
            m[:] = 0.9 * m + 0.1 * g
            s[:] = 0.999 * s + 0.001 * g * g
            p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
        parts[0][-1] = 0
    return Field(names, parts[0][:-1], parts[1], parts[2])


_NUMERIC = re.compile(r"[+0-9 ().-]+")
_CHECK = {"email": lambda s: 0 < s.find("@") < len(s) - 1, "ip": _is_ip, "card": _is_card, "phone": lambda s: _NUMERIC.fullmatch(s) and 7 <= len(_digits(s)) <= 15}


def field_spans(text: str, run: list[tuple[int, int]], tags: np.ndarray) -> list[tuple[int, str, int]]:
    """Spans of a decoded run, without surrounding punctuation, that pass their kind's check."""
    out, i = [], 0
    while i < len(run):
        tag = TAGS[tags[i]]
        if tag == "O":
            i += 1
            continue
        j = i + 1
        while j < len(run) and TAGS[tags[j]] == f"I-{tag[2:]}":
            j += 1
        start, end, kind = run[i][0], run[j - 1][1], tag[2:]
        while start < end and text[start] in "\"'<>[]{},;:.!?":
            start += 1
        while end > start and text[end - 1] in "\"'<>[]{},;:.!?)":
            end -= 1
        if _CHECK[kind](text[start:end]):
            out.append((start, kind, end))
        i = j
    return out


def add_field_spans(texts: list[str], base: list[list], field: Field) -> list[list]:
    """Base spans of each text, and the field's spans that overlap none of them."""
    own = [(i, run) for i, text in enumerate(texts) for run in runs(text)]
    tags = field.decode([run_features(texts[i], run) for i, run in own])
    out = [list(b) for b in base]
    for (i, run), best in zip(own, tags):
        for start, kind, end in field_spans(texts[i], run, best):
            if all(e <= start or end <= s for s, _, e in base[i]):
                out[i].append((start, kind, end))
    return [in_order(spans) for spans in out]


def _make(field: Field) -> Callable:
    def make():
        def step(batch: pa.RecordBatch) -> list[tuple]:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            base = [base_spans(t) if EVIDENCE.search(t) else [] for t in texts]
            rows = []
            for doc, own, spans in zip(ids, base, add_field_spans(texts, base, field)):
                kinds = [kind for _, kind, _ in own]
                rows.append((doc, *map(kinds.count, KINDS), hashlib.sha256(written(own).encode()).hexdigest(), written(spans),
                             len(spans) - len(own)))
            return rows

        return step

    return make


def personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256
    (of the base spans' text form), spans (base and added), n_added.

    Positions are code points, end exclusive; spans are ordered by start, then kind as in ``KINDS``. Null counts as empty;
    a text without spans has empty ``spans``. Repeated rows give repeated rows, an empty table an empty result. Whole texts are read,
    in time proportional to their length. Other columns of ``docs`` are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return map_rows(rows, _make(field or train(labelled_table())),
                    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
