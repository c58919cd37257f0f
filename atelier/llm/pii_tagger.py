"""Personal data: base rules, and a character-level bidirectional LSTM with CRF transitions.

The network is trained in numpy from labelled spans (``labelled_texts``: seeded sentences around
generated addresses, numbers and look-alikes; other labelled texts can be given to ``train``). Its
weights are stored in the shared folder, so that they are trained once and not by each driver.

Texts are cut into overlapping windows, and digits of all scripts and full-width forms are read as
their ASCII characters. A value of one of the four kinds has a digit, an at sign or an at written
out, whatever its form, so windows with none of these near by need not be run: nothing in them could
pass ``checked`` (tests hold the spans against those of all windows). Where windows overlap, their
scores are averaged with more weight to the window in which a character stands further from the
edge, and one Viterbi path per covered stretch settles all of its windows together. Spans of that
path that are sure enough, can be a value of their kind (``checked``) and touch no base span are
added to the base spans. Numbers in words are not searched.

Defined results: null texts count as empty, and have no spans; base spans of different kinds may
overlap; of the method's spans none overlaps another; equal scores take the label listed first;
very long texts are read whole, with memory in line with their length; repeated rows are judged
alike; an empty table gives no rows; only doc_id and text are read, and ``redact`` keeps all columns.
"""

from __future__ import annotations

import hashlib
import random
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from atelier.llm.common import pieces, shared_dir

KINDS = ("email", "ip", "card", "phone")
WINDOW, OVERLAP = 192, 32  # characters; training takes windows of half that size
HIDDEN, EMBED = 16, 12
SURE = 4.0  # log-odds of a span's labels against none, summed over the span, that the method's own spans need
SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long, n_added long"

Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")
_NO_DIGITS = re.compile(r"[^0-9]")
_WRITTEN = re.compile(r"(?:(?<!\s)\s+)?(?:[(\[{<]\s*(at|dot|@|\.)\s*[)\]}>]|(?<=\s)(at|dot)(?=\s))\s*", re.I)
_ASCII = {c: chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)} | {0xFE6B: "@"}
_ASCII |= {c: str(unicodedata.decimal(chr(c))) for c in range(128, sys.maxunicode + 1) if chr(c).isdecimal()}


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the base rules by start, then kind. Linear in the text, whatever it holds."""
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if not _TRIGGER.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NO_DIGITS.sub("", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


# --- characters and labels

_PRINTED = [*range(32, 127), 10]
SYMBOLS = 5 + len(_PRINTED)
LABELS = 1 + 2 * len(KINDS)  # outside; then first and further characters of each kind


@cache
def _code_table() -> np.ndarray:
    """Code of every character: 0 is no character, then other letters, other capitals, other white space, anything else, ASCII."""
    out = np.full(sys.maxunicode + 1, 4, np.uint8)
    for c in range(128, sys.maxunicode + 1):
        x = chr(c)
        if x.isalpha():
            out[c] = 2 if x.isupper() else 1
        elif x.isspace():
            out[c] = 3
    out[9:14] = 3
    for k, c in enumerate(_PRINTED):
        out[c] = 5 + k
    for c, x in _ASCII.items():
        out[c] = out[ord(x)]
    return out


def codes(text: str) -> np.ndarray:
    return _code_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def _allowed() -> tuple[np.ndarray, np.ndarray]:
    moves = np.zeros((LABELS, LABELS))
    for further in range(2, LABELS, 2):
        moves[:, further] = -1e4
        moves[[further - 1, further], further] = 0
    start = np.zeros(LABELS)
    start[2::2] = -1e4
    return moves, start


_MOVES, _START = _allowed()


class Tagger:
    """Parameters: embedding, two LSTMs (forward, backward), output layer, CRF transitions."""

    def __init__(self, seed: int = 3) -> None:
        r = np.random.default_rng(seed)
        size = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"embed": size(SYMBOLS, EMBED) * 2, "out": size(2 * HIDDEN, LABELS), "out_b": np.zeros(LABELS, np.float32), "moves": np.zeros((LABELS, LABELS), np.float32)}
        for d in "fb":
            self.p |= {f"w{d}": size(EMBED + HIDDEN, 4 * HIDDEN), f"b{d}": np.zeros(4 * HIDDEN, np.float32)}
            self.p[f"b{d}"][HIDDEN : 2 * HIDDEN] = 1

    def _lstm(self, x: np.ndarray, d: str, keep: bool):
        """x: steps x rows of codes -> hidden states, steps x rows x HIDDEN; with what backward needs if ``keep``."""
        w = self.p[f"w{d}"]
        inner = self.p["embed"] @ w[:EMBED] + self.p[f"b{d}"]  # of each symbol
        steps, rows = x.shape
        H = HIDDEN
        kind = inner.dtype
        h, c, g, tc = np.zeros((rows, H), kind), np.zeros((rows, H), kind), np.empty((rows, 4 * H), kind), np.empty((rows, H), kind)
        out, saved = np.empty((steps, rows, H), kind), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            before, h_before = c, h
            np.matmul(h, w[EMBED:], out=g)
            g += inner[x[t]]
            s, n = g[:, : 3 * H], g[:, 3 * H :]
            s *= 0.5
            np.tanh(g, out=g)
            s *= 0.5
            s += 0.5
            c = s[:, H : 2 * H] * c
            c += s[:, :H] * n
            np.tanh(c, out=tc)
            h = np.multiply(s[:, 2 * H :], tc, out=out[t])
            if keep:
                saved.append((t, s.copy(), n.copy(), before, tc.copy(), h_before))
        return out, saved

    def scores(self, x: np.ndarray) -> np.ndarray:
        """rows x steps of codes -> rows x steps x LABELS."""
        x, H = np.ascontiguousarray(x.T), HIDDEN
        score = self._lstm(x, "f", False)[0] @ self.p["out"][:H]
        score += self._lstm(x, "b", False)[0] @ self.p["out"][H:]
        score += self.p["out_b"]
        return score.transpose(1, 0, 2)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log-likelihood of the label paths; forward-backward with each step scaled to sum to one."""
        p, rows, steps = self.p, *x.shape
        x = np.ascontiguousarray(x.T)
        e = p["embed"][x]
        f, saved_f = self._lstm(x, "f", True)
        b, saved_b = self._lstm(x, "b", True)
        both = np.concatenate([f, b], axis=2)
        score = (both @ p["out"] + p["out_b"]).astype(np.float64)  # steps x rows x labels
        score = np.exp(score - score.max(2, keepdims=True))
        moves = np.exp(p["moves"] + _MOVES)
        fore, back, scale = np.empty_like(score), np.ones_like(score), np.empty((steps, rows, 1))
        for t in range(steps):
            now = score[t] * (np.exp(_START) if t == 0 else fore[t - 1] @ moves)
            scale[t] = now.sum(1, keepdims=True)
            fore[t] = now / scale[t]
        ahead = score / scale
        for t in range(steps - 2, -1, -1):
            back[t] = (ahead[t + 1] * back[t + 1]) @ moves.T
        ahead *= back
        d = fore * back
        pair = moves * (fore[:-1].reshape(-1, LABELS).T @ ahead[1:].reshape(-1, LABELS))
        d[np.arange(steps)[:, None], np.arange(rows)[None], y.T] -= 1
        pair -= np.bincount(y[:, :-1].ravel() * LABELS + y[:, 1:].ravel(), minlength=LABELS * LABELS).reshape(LABELS, LABELS)
        d = (d / rows).astype(e.dtype)
        g = {"moves": (pair / rows).astype(e.dtype), "out": np.tensordot(both, d, ([0, 1], [0, 1])), "out_b": d.sum((0, 1))}
        upper = d @ p["out"].T
        ge = np.zeros_like(e)
        H = HIDDEN
        for name, saved, part in (("f", saved_f, upper[:, :, :H]), ("b", saved_b, upper[:, :, H:])):
            w = p[f"w{name}"]
            gh, gc = np.zeros((rows, H), e.dtype), np.zeros((rows, H), e.dtype)
            gates, earlier = np.empty((steps, rows, 4 * H), e.dtype), np.empty((steps, rows, H), e.dtype)
            for t, s, n, before, tc, h_before in reversed(saved):
                gh += part[t]
                gc += gh * s[:, 2 * H :] * (1 - tc * tc)
                gate = gates[t]
                np.multiply(gc, n, out=gate[:, :H])
                np.multiply(gc, before, out=gate[:, H : 2 * H])
                np.multiply(gh, tc, out=gate[:, 2 * H : 3 * H])
                gate[:, : 3 * H] *= s * (1 - s)
                np.multiply(gc * s[:, :H], 1 - n * n, out=gate[:, 3 * H :])
                earlier[t] = h_before
                gh = gate @ w[EMBED:].T
                gc *= s[:, H : 2 * H]
            ge += gates @ w[:EMBED].T
            flat = gates.reshape(-1, 4 * H)
            g |= {f"w{name}": np.concatenate([e.reshape(-1, EMBED).T @ flat, earlier.reshape(-1, H).T @ flat]), f"b{name}": flat.sum(0)}
        g["embed"] = np.zeros_like(p["embed"])
        np.add.at(g["embed"], x.ravel(), ge.reshape(-1, EMBED))
        return g


def label_codes(text: str, spans: list[Span]) -> np.ndarray:
    y = np.zeros(len(text), np.int64)
    for kind, a, b in spans:
        k = 1 + 2 * KINDS.index(kind)
        y[a], y[a + 1 : b] = k, k + 1
    return y


def train(examples: list[tuple[str, list[Span]]], rounds: int = 8, rows: int = 96, rate: float = 0.025, seed: int = 3) -> Tagger:
    """Adam over windows of the labelled texts; the rate falls to nothing."""
    tagger, r, width = Tagger(seed), np.random.default_rng(seed), WINDOW // 2
    xs, ys = [], []
    for text, spans in examples:
        x, y = codes(text), label_codes(text, spans)
        for a in range(0, max(1, len(x) - width // 3), width // 2):
            part, labels = x[a : a + width], y[a : a + width].copy()
            if len(labels) and labels[0] and labels[0] % 2 == 0:
                labels[0] -= 1
            xs.append(np.pad(part, (0, width - len(part))))
            ys.append(np.pad(labels, (0, width - len(part))))
    xs, ys = np.array(xs), np.array(ys)
    mean, square = ({k: np.zeros_like(v) for k, v in tagger.p.items()} for _ in range(2))
    step, steps = 0, rounds * -(-len(xs) // rows)
    for _ in range(rounds):
        order = r.permutation(len(xs))
        for low in range(0, len(xs), rows):
            pick = order[low : low + rows]
            g = tagger.gradients(xs[pick], ys[pick])
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            step += 1
            now = rate * (1 - (step - 1) / steps)
            for k, v in g.items():
                v = v * min(1.0, 5.0 / (norm + 1e-9))
                mean[k] = 0.9 * mean[k] + 0.1 * v
                square[k] = 0.99 * square[k] + 0.01 * v * v
                tagger.p[k] -= now * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    return tagger


def labelled_texts(count: int = 2500, seed: int = 8) -> list[tuple[str, list[Span]]]:
    """Sentences with spans of the four kinds, also in forms that the base rules miss, and look-alikes without."""
    r = random.Random(seed)
    syllables = "ka lo mi ter en sh un de ra ion ve st al qu é or ing ly ä ó the of at dot and in".split()
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))

    def word() -> str:
        if r.random() < 0.5:
            w = "".join(r.choice("bcdfghjklmnpqrstvwxyz") + r.choice("aeiouy") + r.choice(["", "", r.choice("bcdfghjklmnpqrstvwxyz")]) for _ in range(r.randint(1, 4)))
        else:
            w = "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
        x = r.random()
        return w.capitalize() if x < 0.15 else w.upper() if x < 0.22 else w

    def plain() -> str:
        return re.sub(r"[^a-z]", "", word().lower()) or "ka"

    def email() -> str:
        local = plain() + r.choice(["", ".", "_", "-", "+"]) + r.choice([plain(), digits(r.randint(1, 4)), ""])
        ends = r.choice(["com", "org", "net", "example.com", "co.uk", "de", plain()[:3]])
        host = plain() + r.choice(["", digits(1), "-" + plain()]) + "." + ends
        local = local.strip("._-+") or "ka"
        x = r.random()
        if x < 0.16:  # written out
            box = r.choice(["()", "[]", "{}", "<>", "  "])
            at, dot = (f"{box[0]}{r.choice([m, m, m.upper()])}{box[1]}" for m in ("at", "dot"))
            gap = "" if box == "  " else r.choice(["", " ", " "])
            host = host.replace(".", f"{gap}{dot}{gap}") if box == "  " or r.random() < 0.6 else host
            return f"{local}{gap}{at}{gap}{host}"
        e = f"{local}@{host}"
        return e.upper() if x < 0.24 else e.replace("@", " @ ") if x < 0.32 else e

    def ip() -> str:
        dot = r.choice([".", ".", ".", ".", ".", " . ", "[.]", " dot ", "(dot)"])
        return dot.join(str(r.randint(0, r.choice([255, 255, 20]))) for _ in range(4))

    def card() -> str:
        body = r.choice("3456") + digits(r.choice([14, 14, 14, 13, 12]))
        number = next(body + c for c in "0123456789" if luhn(body + c))
        x = r.random()
        return r.choice(["  ", "-", "-", " ", "."]).join(number[k : k + 4] for k in range(0, len(number), 4)) if x < 0.35 else number

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return r.choice(
            [f"+1 ({a}) {b}-{c}", f"+{r.randint(1, 99)} {a} {b} {c}", f"+{r.randint(1, 99)}{a}{b}{c}", f"+{r.randint(1, 99)}-{a}-{b}-{c}", f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{r.randint(1, 99)} {a}/{b}{c}", f"+{r.randint(1, 99)}.{a}.{b}.{c}"]
        )

    def other() -> str:
        x = r.randint(0, 15)
        if x > 13:
            return " ".join(r.choice(["at", "dot", "the", plain(), plain(), word()]) for _ in range(r.randint(3, 9)))
        if x == 0:
            return f"{r.randint(0, 9)}.{r.randint(0, 9)}"
        if x == 1:
            return f"{r.randint(1, 28)}.{r.randint(1, 12)}.{r.randint(1990, 2030)}"
        if x == 2:
            return f"{r.randint(1990, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}"
        if x == 3:
            return f'token = "{"".join(r.choice("0123456789abcdef") for _ in range(r.choice([32, 40])))}"'
        if x == 4:
            return f"CC BY-NC {r.randint(1, 4)}.0"
        if x == 5:
            return f"${r.randint(1, 9999)}.{digits(2)}"
        if x == 6:
            return digits(r.randint(1, 8))
        if x == 7:
            return digits(r.randint(21, 30))
        if x == 8:
            return f"{r.randint(300, 999)}.{r.randint(256, 999)}.{digits(3)}.{digits(4)}"
        if x == 9:
            return f"{r.randint(0, 23)}:{digits(2)} @ {word()}"
        if x == 10:
            return f"{r.choice(['look', 'is', plain()])} at {plain()}" + r.choice(["", " dot", f" dot {plain()}", f" and the dot on {plain()}"])
        if x == 11:
            return f"https://{plain()}.{r.choice(['com', 'org', 'net'])}/{plain()}/{digits(r.randint(1, 5))}"
        if x == 12:
            return f"{plain()} {r.choice(['(at)', '[dot]', '(dot)', '@'])} {plain()}"
        return f"{r.randint(1, 20)} . {r.randint(1, 20)} {r.choice(['-', '/', ':', '+'])} {digits(2)}"

    makers = {"email": email, "ip": ip, "card": card, "phone": phone}
    out = []
    for _ in range(count):
        noise = r.random()
        glue = r.choice(["!! ", "### ", "&&& ", " | ", "%%% "]) if noise < 0.15 else " "
        text, spans = "", []
        for _ in range(r.randint(1, 3)):
            for _ in range(r.randint(1, 7)):
                text += word() + r.choice(["", "", "", ",", "."]) + (glue if glue != " " else r.choice([" ", " ", " ", "\n"]))
            if r.random() < 0.6:
                for _ in range(r.choice([1, 1, 1, 2, 3])):  # now and then values in a row
                    kind = r.choice(KINDS)
                    value = makers[kind]()
                    spans.append((kind, len(text), len(text) + len(value)))
                    text += value + r.choice(["", "", "", ".", ",", "!!", "###"]) + " "
            else:
                text += other() + r.choice([" ", ", ", ". "])
        text += word()
        out.append((text, spans))
    return out


@cache
def trained(count: int = 3000, rounds: int = 8, seed: int = 8) -> Tagger:
    return train(labelled_texts(count, seed), rounds)


def stored(spark: SparkSession, name: str = "pii-tagger") -> Tagger:
    """The trained network, read from the shared folder or trained and written there for the next driver.

    The folder's name holds a digest of this file, so other code trains anew; what is not whole is not read.
    """
    with open(__file__, "rb") as f:
        path = f"{shared_dir(spark)}/atelier/{name}-{hashlib.sha256(f.read()).hexdigest()[:16]}"
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    tagger = Tagger()
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        tagger = trained()
        rows = [(k, v.astype(np.float64).ravel().tolist()) for k, v in tagger.p.items()]
        spark.createDataFrame(rows, "name string, weights array<double>").coalesce(1).write.mode("overwrite").parquet(path)
        return tagger
    for r in spark.read.parquet(path).collect():
        tagger.p[r["name"]] = np.array(r["weights"], np.float32).reshape(tagger.p[r["name"]].shape)
    return tagger


# --- decoding


# What any value of the four kinds has, whatever its form: a digit, an at sign, or an at written out.
_HOLDS = np.zeros(SYMBOLS, bool)
_HOLDS[[5 + k for k, c in enumerate(_PRINTED) if chr(c) in "0123456789@"]] = True
_BOXED_AT = re.compile(r"[(\[{<]\s{0,9}at\s{0,9}[)\]}>]", re.I)
_PLAIN_AT = re.compile(r"\sat\s(?=\S{1,64}\.\w|.{1,80}\sdot\s)", re.S | re.I)
_WEIGHT = np.minimum(np.arange(WINDOW) + 1, np.arange(WINDOW, 0, -1)).astype(np.float32)[:, None]
TOGETHER = 768  # windows that go through the network at once
NEAR = 64  # characters on both sides of what a value must have that are read at least


def window_starts(length: int) -> np.ndarray:
    """Windows over a text: OVERLAP characters in common, the last one ending with the text."""
    last = max(0, length - WINDOW)
    return np.append(np.arange(0, last, WINDOW - OVERLAP), last)


def hints(text: str, x: np.ndarray) -> np.ndarray:
    """Places of what a value must have."""
    out = np.flatnonzero(_HOLDS[x])
    written = [m.start() for form in (_BOXED_AT, _PLAIN_AT) for m in form.finditer(text)]
    if written:
        out = np.sort(np.append(out, written))
    return out


def stretch_scores(texts: list[str], tagger: Tagger, whole: bool = False) -> list[tuple[int, int, np.ndarray]]:
    """(text, start, characters x LABELS) of each stretch that windows cover; with ``whole``, all windows."""
    starts, places, flat, size = [], [], [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        x = codes(text)
        own = window_starts(len(x))
        if not whole:
            at = hints(text, x)
            own = own[np.searchsorted(at, own + WINDOW + NEAR) > np.searchsorted(at, own - NEAR)]
        if not len(own):
            continue
        jumps = np.flatnonzero(np.diff(own) > WINDOW) + 1
        for part in np.split(own, jumps):
            a, b = int(part[0]), int(part[-1]) + WINDOW
            starts.append(part - a + size)
            places.append((i, a, size, min(b, len(x)) - a))
            held = x[a:b]
            flat += [held, np.zeros(b - a - len(held), np.uint8)]
            size += b - a
    if not places:
        return []
    starts = np.concatenate(starts)
    windows = np.lib.stride_tricks.sliding_window_view(np.concatenate(flat), WINDOW)
    total, weight = np.zeros((size, LABELS), np.float32), np.zeros((size, 1), np.float32)
    for low in range(0, len(starts), TOGETHER):
        some = starts[low : low + TOGETHER]
        for s, part in zip(some.tolist(), tagger.scores(windows[some]) * _WEIGHT, strict=True):
            total[s : s + WINDOW] += part
            weight[s : s + WINDOW] += _WEIGHT
    total /= weight
    return [(i, a, total[s : s + n]) for i, a, s, n in places]


CHUNK, LONG_STRETCH = 256, 4096


def long_viterbi(score: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best label path of one long stretch, its chunks side by side.

    For each chunk, the best value from every label before it to every label at its end; these are
    composed from chunk to chunk, which gives the labels at all chunks' ends, and with them each
    chunk's path. The same path as step by step, in a two-hundredth of the steps.
    """
    many = len(score) // CHUNK
    parts = score[: many * CHUNK].reshape(many, CHUNK, LABELS).astype(np.float64)
    through = np.empty((many, LABELS, LABELS))
    for low in range(0, many, 1024):
        some = parts[low : low + 1024]
        value = moves[None] + some[:, 0, None, :]
        for t in range(1, CHUNK):
            value = (value[:, :, :, None] + moves).max(2) + some[:, t, None, :]
        through[low : low + 1024] = value
    first = _START + parts[0, 0]
    for t in range(1, CHUNK):
        first = (first[:, None] + moves).max(0) + parts[0, t]
    best, came = [first], []
    for j in range(1, many):
        z = best[-1][:, None] + through[j]
        came.append(z.argmax(0))
        best.append(z.max(0))
    final, tail_back = best[-1], []
    for row in score[many * CHUNK :].astype(np.float64):
        z = final[:, None] + moves
        tail_back.append(z.argmax(0))
        final = z.max(0) + row
    path = np.empty(len(score), np.int64)
    now = int(final.argmax())
    for k in range(len(tail_back) - 1, -1, -1):
        path[many * CHUNK + k] = now
        now = int(tail_back[k][now])
    ends = np.empty(many, np.int64)
    for j in range(many - 1, -1, -1):
        ends[j] = now
        now = int(came[j - 1][now]) if j else now
    begin = moves[ends[:-1]]  # of the labels before all chunks but the first
    rows = np.arange(many)
    value = np.concatenate([_START[None], begin]) + parts[:, 0]
    back = np.zeros((CHUNK, many, LABELS), np.int8)
    for t in range(1, CHUNK):
        z = value[:, :, None] + moves
        back[t] = z.argmax(1)
        value = z.max(1) + parts[:, t]
    inner, now = path[: many * CHUNK].reshape(many, CHUNK), ends
    for t in range(CHUNK - 1, -1, -1):
        inner[:, t] = now
        now = back[t, rows, now]
    return path


def viterbi(jobs: list[np.ndarray], moves: np.ndarray) -> list[np.ndarray]:
    """Best label path of each stretch (steps x LABELS of scores); stretches of like lengths go together."""
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(jobs)
    order = sorted(range(len(jobs)), key=lambda k: -len(jobs[k]))
    low = 0
    while low < len(order) and len(jobs[order[low]]) >= LONG_STRETCH:
        out[order[low]] = long_viterbi(jobs[order[low]], moves)
        low += 1
    while low < len(order):
        steps = len(jobs[order[low]])
        group = order[low : low + max(1, min(512, 400_000 // steps))]
        low += len(group)
        lengths = np.array([len(jobs[k]) for k in group])
        held = np.zeros((steps, len(group), LABELS), np.float32)
        for j, k in enumerate(group):
            held[: lengths[j], j] = jobs[k]
        best = held[0] + _START
        back = np.zeros((steps, len(group), LABELS), np.int8)
        final = best.copy()
        for t in range(1, steps):
            live = int(np.searchsorted(-lengths, -t, "left"))
            z = best[:live, :, None] + moves
            back[t, :live] = z.argmax(1)
            best = z.max(1) + held[t, :live]
            final[:live] = best
        now = final.argmax(1)
        paths = np.zeros((steps, len(group)), np.int64)
        rows = np.arange(len(group))
        for t in range(steps - 1, -1, -1):
            paths[t] = now
            now = np.where(t < lengths, back[t, rows, now], now)
        for j, k in enumerate(group):
            out[k] = paths[: lengths[j], j]
    return out


def tagged_spans(texts: list[str], tagger: Tagger, whole: bool = False) -> list[list[Span]]:
    """The method's sure spans of each text."""
    found: list[list[Span]] = [[] for _ in texts]
    jobs = stretch_scores(texts, tagger, whole)
    paths = viterbi([score for *_, score in jobs], tagger.p["moves"] + _MOVES)
    for (i, a, score), path in zip(jobs, paths, strict=True):
        for s in np.flatnonzero(path % 2 == 1).tolist():
            kind, e = int(path[s]), s + 1
            while e < len(path) and path[e] == kind + 1:
                e += 1
            own = score[np.arange(s, e), path[s:e]]
            if float((own - score[s:e, 0]).sum()) >= SURE:
                found[i].append((KINDS[kind // 2], a + s, a + e))
    return found


def folded(text: str) -> tuple[str, list[tuple[int, int]]]:
    """The text in ASCII forms and signs, and what part of ``text`` each character stands for."""
    plain = text if text.isascii() else text.translate(_ASCII)
    out, places, at = [], [], 0
    for m in _WRITTEN.finditer(plain):
        out += [plain[at : m.start()], "@" if m[m.lastindex].lower() in ("at", "@") else "."]
        places += [(k, k + 1) for k in range(at, m.start())] + [m.span()]
        at = m.end()
    return "".join([*out, plain[at:]]), places + [(k, k + 1) for k in range(at, len(plain))]


_EDGES = {"email": re.compile(r"[^\W_][\w.%+-]* ?@ ?[\w-]+(?: ?\. ?[\w-]+)+"), "ip": re.compile("[0-9].*[0-9]", re.S), "phone": re.compile("[+(]?[0-9].*[0-9]", re.S)}
_CAN_BE = {
    "email": bool,
    "ip": lambda x: len(n := re.findall("[0-9]+", x)) == 4 and all(len(k) <= 3 and int(k) <= 255 for k in n),
    "phone": lambda x: 9 <= len(_NO_DIGITS.sub("", x)) <= 15,
}


def _card_numbers(text: str) -> list[tuple[int, int]]:
    """Runs of digit groups that pass as cards, longest first from the left."""
    groups = [m.span() for m in re.finditer("[0-9]+", text)]
    out, k = [], 0
    while k < len(groups):
        for last in range(min(len(groups), k + 8) - 1, k - 1, -1):
            digits = _NO_DIGITS.sub("", text[groups[k][0] : groups[last][1]])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((groups[k][0], groups[last][1]))
                k = last
                break
        k += 1
    return out


_ONE_OF_SEVERAL = {"ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\s?\.\s?[0-9]{1,3}){3}(?![0-9])"), "phone": re.compile(r"[+(]?[0-9](?:[0-9\x20().-]*[0-9])?")}


def checked(text: str, kind: str, a: int, b: int) -> list[Span]:
    """The spans of a tagged stretch that values of its kind can be, whatever their form, each cut to its edges.

    A stretch of numbers that is no value as a whole may hold several.
    """
    part, places = folded(text[a:b])
    if kind == "card":
        found = _card_numbers(part)
    else:
        found = [m.span() for m in _EDGES[kind].finditer(part) if _CAN_BE[kind](m[0])]
        if not found and kind in _ONE_OF_SEVERAL:
            found = [m.span() for m in _ONE_OF_SEVERAL[kind].finditer(part) if _CAN_BE[kind](m[0])]
    return [(kind, a + places[s][0], a + places[e - 1][1]) for s, e in found]


def all_spans(texts: list[str], tagger: Tagger) -> tuple[list[list[Span]], list[list[Span]]]:
    """(base spans, all spans) of each text, by start, then kind."""
    base = [base_spans(t) for t in texts]
    both = []
    for text, own, more in zip(texts, base, tagged_spans(texts, tagger), strict=True):
        extra = []
        for tagged in more:
            extra += [x for x in checked(text, *tagged) if all(x[2] <= s or e <= x[1] for _, s, e in own)]
        both.append(sorted(own + extra, key=lambda s: (s[1], KINDS.index(s[0]))))
    return base, both


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def tag_documents(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every whole text. Narrow: one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger or stored(docs.sparkSession))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                base, both = all_spans([t or "" for t in part.column("text").to_pylist()], shared.value)
                counts = [pa.array([sum(s[0] == k for s in own) for own in base], pa.int64()) for k in KINDS]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), *counts, pa.array([hashlib.sha256(joined(s).encode()).hexdigest() for s in base]), pa.array([joined(s) for s in both], pa.string()), pa.array([len(x) for x in both], pa.int64()), pa.array([len(x) - len(y) for x, y in zip(both, base, strict=True)], pa.int64())],
                    names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_spans", "n_added"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def masked(text: str, spans: list[Span]) -> str:
    """Spans replaced by their kind; overlapping ones by the first one's."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """``docs`` with personal data replaced in text, and n_chars (if there) counted anew."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger or stored(docs.sparkSession))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                texts = part.column("text").to_pylist()
                _, both = all_spans([t or "" for t in texts], shared.value)
                new = [t if t is None or not s else masked(t, s) for t, s in zip(texts, both, strict=True)]
                columns = {n: part.column(n) for n in part.schema.names}
                columns["text"] = pa.array(new, part.schema.field("text").type)
                if "n_chars" in columns:
                    field = part.schema.field("n_chars")
                    old = columns["n_chars"].to_pylist()
                    columns["n_chars"] = pa.array([o if not s else len(t) for o, t, s in zip(old, new, both, strict=True)], field.type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), schema=part.schema)

    return docs.mapInArrow(run, docs.schema)
