"""Personal data: base patterns, and a character-level bidirectional LSTM with CRF transitions.

The network is written and trained in numpy. Its labelled spans are those that
the base patterns mark in a bounded sample of windows, and copies of these with
other digits and in broken forms (blanks, other separators, a spelled-out at
sign, a lost plus sign), set into windows of the sample and tagged by kind. So
it finds further spans that the patterns miss. Only stretches of text near a
digit or an at sign (a spelled-out one in brackets too) are decoded: every span
must have one of them, so nothing can lie elsewhere. A stretch is cut into
overlapping windows; the scores of each character, weighted towards the middle
of its windows, are brought together, and one best path is decoded over the
whole stretch. How sure a span must be is set on held-out copies.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, share, slices, with_columns

KINDS = ("email", "ip", "card", "phone")
#: Bounds of the training sample: documents with personal data, and windows of these around a digit or at sign, both by
#: order of a hash. They bind the training only: decoding covers whole texts.
SAMPLE_DOCS, SAMPLE_WINDOWS = 600, 2_000
#: Copies of labelled spans of each kind that are set into windows, and every how many-th is held out.
COPIES, HELD_OUT = 500, 8
#: Characters of a window, and by how many the next one is further on; characters kept around a digit or at sign.
WINDOW, STRIDE, MARGIN = 64, 32, 24
HIDDEN, EMBED, STEPS, BATCH, RATE = 20, 12, 800, 32, 0.02
#: The mean probability that a span needs is the largest of these that keeps this share of the held-out spans.
SURE, RECALL = (0.98, 0.95, 0.9, 0.8, 0.7, 0.6, 0.5), 0.96

_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: An at sign or a dot, spelled out in brackets.
_AT, _DOT = r"[(\[{]\s*(?:at|@)\s*[)\]}]", r"[(\[{]\s*(?:dot|\.)\s*[)\]}]"
_TRIGGER = re.compile(rf"[0-9@]|{_AT}", re.IGNORECASE)
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int, int]  # start, number of the kind, end


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """What the base patterns mark, each kind leftmost and non-overlapping, sorted by start and kind."""
    found: list[Span] = []
    at, free = text.find("@"), 0
    while at >= 0:  # the local part is all of its characters before the at sign, after the last match
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            found.append((start, 0, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if any(c in text for c in "0123456789"):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def told(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


# Characters as the network sees them: ASCII as it is, all others as one of a few classes.
def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, points, 128 + (points >= 0x250)).astype(np.int64)


N_CODES = 130
#: Tags: 0 is outside; kind k has 1 + 2 k for its first and 2 + 2 k for its other characters.
N_TAGS = 1 + 2 * len(KINDS)


def _softplus_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    """Embedding, one LSTM in each direction, linear emissions, CRF transitions; float32."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.Generator(np.random.PCG64(seed))
        h, e = HIDDEN, EMBED
        wide = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.sure = SURE[0]
        self.p = {"embed": wide(N_CODES, e) * 3, "out": wide(2 * h, N_TAGS), "bias": np.zeros(N_TAGS, np.float32), "move": np.zeros((N_TAGS, N_TAGS), np.float32)}
        for d in ("f", "b"):
            self.p |= {f"x{d}": wide(e, 4 * h), f"h{d}": wide(h, 4 * h), f"c{d}": np.zeros(4 * h, np.float32)}
            self.p[f"c{d}"][h : 2 * h] = 1  # remember at first

    def _lstm(self, d: str, x: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """x: (time, batch, embed). Gates: input, forget, output, candidate."""
        h = HIDDEN
        drive = x @ self.p[f"x{d}"] + self.p[f"c{d}"]
        out = np.zeros((*x.shape[:2], h), np.float32)
        hidden, cell, past = np.zeros_like(out[0]), np.zeros_like(out[0]), []
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            z = drive[t] + hidden @ self.p[f"h{d}"]
            gates, new = _sigmoid(z[:, : 3 * h]), np.tanh(z[:, 3 * h :])
            before, was = cell, hidden
            cell = gates[:, h : 2 * h] * cell + gates[:, :h] * new
            squashed = np.tanh(cell)
            hidden = out[t] = gates[:, 2 * h :] * squashed
            if keep:
                past.append((t, gates, new, before, was, squashed))
        return out, past

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """x: character codes (time, batch)."""
        e = self.p["embed"][x]
        both = np.concatenate([self._lstm("f", e, False)[0], self._lstm("b", e, False)[0]], axis=2)
        return both @ self.p["out"] + self.p["bias"]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tags, and its gradients."""
        p, h, (steps, n) = self.p, HIDDEN, x.shape
        e = p["embed"][x]
        of, pf = self._lstm("f", e, True)
        ob, pb = self._lstm("b", e, True)
        both = np.concatenate([of, ob], axis=2)
        emit = both @ p["out"] + p["bias"]

        alpha, beta = np.empty_like(emit), np.zeros_like(emit)
        alpha[0] = emit[0]
        for t in range(1, steps):
            alpha[t] = _softplus_sum(alpha[t - 1][:, :, None] + p["move"], 1) + emit[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = _softplus_sum(p["move"] + (emit[t + 1] + beta[t + 1])[:, None, :], 2)
        total = _softplus_sum(alpha[-1], 1)
        rows = np.arange(n)
        gold = sum(emit[t, rows, y[t]] for t in range(steps)) + sum(p["move"][y[t - 1], y[t]] for t in range(1, steps))
        loss = float((total - gold).mean())

        g = {k: np.zeros_like(v) for k, v in p.items()}
        d_emit = np.exp(alpha + beta - total[None, :, None])
        for t in range(steps):
            d_emit[t, rows, y[t]] -= 1
            if t:
                pair = np.exp(alpha[t - 1][:, :, None] + p["move"] + (emit[t] + beta[t])[:, None, :] - total[:, None, None])
                g["move"] += pair.sum(axis=0)
                np.add.at(g["move"], (y[t - 1], y[t]), -1)
        d_emit = (d_emit / n).astype(np.float32)
        g["move"] /= n
        g["bias"] = d_emit.sum(axis=(0, 1))
        g["out"] = np.einsum("tbh,tbk->hk", both, d_emit)
        d_both = d_emit @ p["out"].T
        d_e = np.zeros_like(e)
        for d, past, d_out in (("f", pf, d_both[:, :, :h]), ("b", pb, d_both[:, :, h:])):
            d_hidden, d_cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
            for t, gates, new, before, was, squashed in reversed(past):
                d_h = d_out[t] + d_hidden
                i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
                d_cell = d_cell + d_h * o * (1 - squashed**2)
                dz = np.concatenate([d_cell * new * i * (1 - i), d_cell * before * f * (1 - f), d_h * squashed * o * (1 - o), d_cell * i * (1 - new**2)], axis=1)
                g[f"x{d}"] += e[t].T @ dz
                g[f"h{d}"] += was.T @ dz
                g[f"c{d}"] += dz.sum(axis=0)
                d_e[t] += dz @ p[f"x{d}"].T
                d_hidden, d_cell = dz @ p[f"h{d}"].T, d_cell * f
        np.add.at(g["embed"], x.ravel(), d_e.reshape(-1, d_e.shape[2]))
        return loss, g

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 11, steps: int = STEPS) -> list[float]:
        """Adam over shuffled batches of windows (time, window), a fixed number of steps; the loss of each."""
        rng = np.random.Generator(np.random.PCG64(seed))
        m, v = ({k: np.zeros_like(w) for k, w in self.p.items()} for _ in range(2))
        losses: list[float] = []
        order = np.zeros(0, np.int64)
        for step in range(1, steps + 1):
            if len(order) < BATCH:
                order = np.concatenate([order, rng.permutation(x.shape[1])])
            some, order = order[:BATCH], order[BATCH:]
            loss, g = self.gradients(x[:, some], y[:, some])
            losses.append(loss)
            size = np.sqrt(sum(float((w**2).sum()) for w in g.values()))
            for k in self.p:
                d = g[k] * min(1.0, 5 / max(size, 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.99 * v[k] + 0.01 * d**2
                self.p[k] -= (RATE * (1 - step / (steps + 1)) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return losses


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of the text around digits and at signs; those that meet are one."""
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _windows(size: int) -> list[int]:
    """Where the overlapping windows of a stretch begin; the last may go past its end."""
    return list(range(0, max(1, size - WINDOW + STRIDE), STRIDE)) if size > WINDOW else [0]


def _padded(own: np.ndarray, start: int) -> np.ndarray:
    x = np.full(WINDOW, 32, np.int64)
    part = own[start : start + WINDOW]
    x[: len(part)] = part
    return x


def _tagged(text: str, spans: list[Span]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Windows around the text's digits and at signs, and their tags."""
    tags = np.zeros(len(text), np.int64)
    for a, k, b in spans:
        if not tags[a:b].any():
            tags[a:b] = 2 + 2 * k
            tags[a] = 1 + 2 * k
    own, xs, ys = codes(text), [], []
    for a, b in stretches(text):
        for s in _windows(b - a):
            xs.append(_padded(own[a:b], s))
            y = np.zeros(WINDOW, np.int64)
            part = tags[a:b][s : s + WINDOW]
            y[: len(part)] = part
            ys.append(y)
    return xs, ys


def training_windows(tagged: list[tuple[str, list[Span]]]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all texts around digits and at signs, and the tags of their spans: (time, window) each."""
    parts = [_tagged(text, spans) for text, spans in tagged]
    xs, ys = [x for p in parts for x in p[0]], [y for p in parts for y in p[1]]
    if not xs:
        return np.zeros((WINDOW, 0), np.int64), np.zeros((WINDOW, 0), np.int64)
    return np.array(xs).T, np.array(ys).T


def varied(kind: int, span: str, words: list[str], rng: np.random.Generator) -> str:
    """The span with other digits and names, and two times of three in a form that the base patterns may miss."""
    digits = lambda x: "".join(str(rng.integers(10)) if c.isdigit() else c for c in x)
    pick = lambda *x: x[rng.integers(len(x))]
    broken = rng.random() < 2 / 3
    if kind == 0:
        local, domain = digits(span).split("@", 1)
        name = lambda: words[rng.integers(len(words))][: rng.integers(2, 12)]
        if words and rng.random() < 3 / 4:
            local = f"{name()}{pick('', '.', '_', '-')}{pick(name(), str(rng.integers(1000)), '')}".rstrip("._-")
            domain = pick(name(), f"{name()}-{name()}", f"{name()}.{name()}", f"{name()}{rng.integers(10)}") + pick(".com", ".org", ".de", ".net", ".fr", "." + name()[:3])
            local, domain = (x.lower() if rng.random() < 0.8 else x for x in (local, domain))
        if not broken:
            return f"{local}@{domain}"
        at = pick("(at)", "[at]", "{at}", "(AT)", "@", "(@)", "[ at ]")
        dot = pick(".", ".", "(dot)", "[dot]", "[.]", ".")
        gap, near = pick("", " "), pick("", "", " ")
        if at == "@":  # only a gap breaks it
            gap = " "
        return f"{local}{gap}{at}{gap}" + domain.replace(".", f"{near}{dot}{near}")
    if kind == 1:
        parts = [str(rng.integers(256)) for _ in range(4)]
        return (pick(" . ", "[.]", ". ", " .", ",", "(.)", " , ", ", ", "[dot]") if broken else ".").join(parts)
    if kind == 2:
        own = digits("".join(c for c in span if c.isdigit()))
        size = pick(4, 4, 4, 5)
        groups = [own[k : k + size] for k in range(0, len(own), size)]
        return (pick(".", "/", "_", "  ", " - ", ":", ",", ". ", " / ") if broken else pick(" ", "-", "")).join(groups)
    own = digits("".join(c for c in span if c.isdigit()))
    head, area = own[: pick(1, 2, 2, 3)], pick(2, 3, 3, 4)
    rest = own[len(head) :]
    first, rest = rest[:area], rest[area:]
    cut = pick(3, 4, len(rest))
    last = pick(" ", "-", " ", "").join(x for x in (rest[:cut], rest[cut:]) if x)
    if not broken:
        return f"+{head}{pick(' ', ' (')}{first}".replace(f"({first}", f"({first})") + pick(" ", "-") + last
    return pick(
        f"+ {head} {first} {last}", f"00{head} {first} {last}", f"(0{first}) {last}", f"0{first}/{last}", f"0{first} - {last}", f"+{head}/{first}/{last}",
        f"(+{head}) {first} {last}", f"{head}-{first}-{last}", f"+ {head}({first}){last}", f"+{head}_{first}_{last}", f"00 {head} {first}/{last}", f"({first}) {last}", f"+ {head}-{first}-{last}",
    )


def copies(sample: list[str], seed: int = 13) -> list[tuple[str, list[Span]]]:
    """Windows of the sample with a copy of a labelled span set in between two of their words; it is the first of the
    window's spans."""
    rng = np.random.Generator(np.random.PCG64(seed))
    pool: dict[int, list[str]] = {}
    for text in sample:
        for a, k, b in base_spans(text):
            pool.setdefault(k, []).append(text[a:b])
    names = sorted({w for text in sample for w in re.findall("[A-Za-z]{2,}", text)})
    out = []
    for k in sorted(pool):
        for _ in range(COPIES):
            text = sample[rng.integers(len(sample))]
            span = varied(k, pool[k][rng.integers(len(pool[k]))], names, rng)
            words = re.split("([ \n])", text)
            at = 2 * int(rng.integers(len(words) // 2 + 1))
            before, after = "".join(words[:at]), "".join(words[at:])
            after = f"{('', '.', ',', '.')[rng.integers(4)]} {after}"
            more = len(before) + len(span)
            spans = [(len(before), k, more), *base_spans(before), *((a + more, j, b + more) for a, j, b in base_spans(after))]
            out.append((f"{before}{span}{after}", spans))
    return out


def trained(sample: list[str]) -> Tagger:
    """The network, trained on the sample's windows and on most copies; the held-out ones tell how sure spans must be."""
    tagger, made = Tagger(), copies(sample)
    x, y = training_windows([(text, base_spans(text)) for text in sample] + [m for k, m in enumerate(made) if k % HELD_OUT])
    if not x.shape[1] or not made:
        tagger.p["bias"][0] = 30  # nothing learned: all characters are outside
        return tagger
    tagger.train(x, y)
    held = made[::HELD_OUT]
    for tagger.sure in SURE:
        found = network_spans([text for text, _ in held], tagger, every=True)
        if sum(spans[0] in own for (_, spans), own in zip(held, found, strict=True)) >= RECALL * len(held):
            break
    return tagger


def decode(emit: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best paths over whole stretches, and the probability of each of their tags.

    emit: (time, stretch, tag), the last step of each stretch at least being a padding that only tag 0 fits.
    """
    n, many, _ = emit.shape
    best, back = emit[0].copy(), np.zeros(emit.shape, np.int8)
    alpha, beta = emit.copy(), np.zeros_like(emit)
    for t in range(1, n):
        reach = best[:, :, None] + move
        back[t] = reach.argmax(axis=1)
        best = reach.max(axis=1) + emit[t]
        alpha[t] = _softplus_sum(alpha[t - 1][:, :, None] + move, 1) + emit[t]
    path, rows = np.zeros((n, many), np.int64), np.arange(many)
    path[-1] = best.argmax(axis=1)
    for t in range(n - 1, 0, -1):
        path[t - 1] = back[t, rows, path[t]]
    for t in range(n - 2, -1, -1):
        beta[t] = _softplus_sum(move + (emit[t + 1] + beta[t + 1])[:, None, :], 2)
    total = _softplus_sum(alpha[-1], 1)
    sure = np.exp(alpha + beta - total[None, :, None])
    return path, np.take_along_axis(sure, path[:, :, None], axis=2)[:, :, 0]


_WEIGHT = (np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1]) + 1).astype(np.float32)


def _runs(path: np.ndarray, sure: np.ndarray, least: float) -> Iterator[Span]:
    """Spans of a path of tags that are sure enough."""
    t = 0
    while t < len(path):
        u = t + 1
        if path[t] % 2:
            while u < len(path) and path[u] == path[t] + 1:
                u += 1
            if sure[t:u].mean() >= least:
                yield t, int(path[t] - 1) // 2, u
        t = u


def network_spans(texts: list[str | None], tagger: Tagger, step: int = 512, every: bool = False) -> list[list[Span]]:
    """The spans that the network marks in each text, sure and plausible ones only (or every sure one)."""
    todo: list[tuple[int, int, int, np.ndarray]] = []
    out: list[list[Span]] = [[] for _ in texts]
    for i, text in enumerate(texts):
        if text and (parts := stretches(text)):
            own = codes(text)
            todo += [(i, a, b, own[a:b]) for a, b in parts]
    for c in range(0, len(todo), step):
        some = todo[c : c + step]
        starts = [(j, s) for j, (_, a, b, _) in enumerate(some) for s in _windows(b - a)]
        sums = [np.zeros((b - a, N_TAGS), np.float32) for _, a, b, _ in some]
        weight = [np.zeros((b - a, 1), np.float32) for _, a, b, _ in some]
        for w in range(0, len(starts), step):
            here = starts[w : w + step]
            emit = tagger.emissions(np.array([_padded(some[j][3], s) for j, s in here]).T)
            for q, (j, s) in enumerate(here):
                size = min(WINDOW, len(sums[j]) - s)
                sums[j][s : s + size] += emit[:size, q] * _WEIGHT[:size, None]
                weight[j][s : s + size, 0] += _WEIGHT[:size]
        order = sorted(range(len(some)), key=lambda j: len(sums[j]))
        for w in range(0, len(order), 64):
            here = order[w : w + 64]
            emit = np.full((len(sums[here[-1]]) + 1, len(here), N_TAGS), -60, np.float32)
            emit[:, :, 0] = 0
            for q, j in enumerate(here):
                emit[: len(sums[j]), q] = sums[j] / weight[j]
            path, sure = decode(emit, tagger.p["move"])
            for q, j in enumerate(here):
                i, a = some[j][:2]
                out[i] += [(a + t, k, a + u) for t, k, u in _runs(path[: len(sums[j]), q], sure[:, q], tagger.sure) if every or plausible(k, texts[i][a + t : a + u])]
    for spans in out:
        spans.sort()
    return out


def plausible(kind: int, found: str) -> bool:
    """A span without the marks of its kind is none, however sure the network is."""
    numbers = re.findall("[0-9]+", found)
    digits = "".join(numbers)
    if kind == 0:
        at = re.search(f"@|{_AT}", found, re.IGNORECASE)
        return bool(at and at.start() and re.search(rf"\w\s*(\.|{_DOT})\s*\w", found[at.end() :], re.IGNORECASE))
    if kind == 1:
        return len(numbers) == 4 and all(len(n.lstrip("0")) <= 3 and int(n) <= 255 for n in numbers)
    if any(c.isalpha() for c in found):
        return False
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15 and not found.isdigit()


def all_spans(text: str | None, added: list[Span]) -> tuple[list[Span], list[Span]]:
    """Base spans, and these with the added ones that overlap none of them."""
    base = base_spans(text or "")
    both = list(base)
    for a, k, b in added:
        if all(b <= x or a >= y for x, _, y in both):
            both.append((a, k, b))
    return base, sorted(both)


def learn(docs: DataFrame) -> Tagger:
    """The network, trained on at most SAMPLE_WINDOWS windows of SAMPLE_DOCS texts with an at sign or a stretch of digits.

    Texts are taken by order of a hash: the hashes are read first, then the windows of the texts that have them, and
    these by order of a hash too, each whole.
    """
    text = F.col("text")
    h = F.xxhash64("text")
    marked = docs.where(text.rlike("[0-9][0-9 ().-]{5,}[0-9]|@"))
    first = [r[0] for r in marked.select(h.alias("h")).distinct().orderBy("h").limit(SAMPLE_DOCS).collect()]
    if not first:
        return trained([])
    near = F.regexp_extract_all(text, F.lit(r"(?s).{0,40}[0-9@].{0,60}"), F.lit(0))
    windows = docs.where(h <= F.lit(first[-1])).select(F.explode(near).alias("w")).distinct()
    sample = windows.orderBy(F.xxhash64("w"), "w").limit(SAMPLE_WINDOWS).collect()
    return trained([r[0] for r in sample])


def find_personal_data(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """All columns and rows of ``docs`` and a struct ``personal`` (underscores go in front of a taken name) of
    n_email, n_ip, n_card, n_phone (base spans), base (kind:start:end, comma-joined) and spans (all, likewise).

    Offsets are code points, ends exclusive. Null and empty texts have no spans; repeated rows get the same ones; a
    span of the network that overlaps a base span, or an earlier one of its own, is left out; no rows give none.
    """
    name = fresh(docs.columns, "personal")
    shared = share(docs.sparkSession, tagger)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared()
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            rows = []
            for text, added in zip(texts, network_spans(texts, own), strict=True):
                base, both = all_spans(text, added)
                kinds = [k for _, k, _ in base]
                rows.append({f"n_{x}": kinds.count(k) for k, x in enumerate(KINDS)} | {"base": told(base), "spans": told(both)})
            fields = [(f"n_{k}", pa.int64()) for k in KINDS] + [("base", pa.string()), ("spans", pa.string())]
            yield with_columns(batch, {name: pa.array(rows, pa.struct(fields))})

    kind = T._parse_datatype_string("struct<" + "".join(f"n_{k}:bigint," for k in KINDS) + "base:string,spans:string>")
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, kind)]))


def masked(text: str | None, spans: str) -> str | None:
    """The text with each span replaced by its kind in brackets."""
    if not spans:
        return text
    out, at = [], 0
    for kind, a, b in (x.split(":") for x in spans.split(",")):
        if int(a) >= at:
            out += [text[at : int(a)], f"<{kind}>"]
            at = int(b)
    return "".join([*out, text[at:]])


def personal_data_report(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_sha256 and spans of every document.

    Null and empty texts have no spans; repeated rows, and rows without doc_id, get theirs each; where no text has a
    labelled span the network adds none; no rows, none.
    """
    narrow = docs.select("doc_id", "text")
    p = find_personal_data(narrow, learn(narrow))
    counts = [F.col(f"personal.n_{k}") for k in KINDS]
    return p.select("doc_id", *counts, F.sha2(F.col("personal.base").cast("binary"), 256).alias("base_sha256"), "personal.spans")
