"""Personal data: pattern spans, and further spans chosen by boosted trees.

Base spans follow fixed patterns with checks (octets, Luhn, digit counts) and
always stay. High-recall generators propose further, overlapping candidates:
bracketed or spaced addresses, loose number groups, numbers without a prefix.
Gradient-boosted trees score each candidate by format, check and context
features (lengths, groups, separators, Luhn and octet results, the characters
around it). They are trained here on a bounded draw of the documents that hold
candidates. Positives are base spans rewritten in place into loose forms
(``loosened``) that no base pattern matches and that keep a mark of their kind;
negatives are candidates clear of base spans, those that miss the ends of a
rewritten one, and those in ordinary numbers (dates, prices, ranges, article
numbers, ids: ``ordinary``) put in the place of a base span, so that the same
contexts speak for both. An isotonic fit on held-out documents turns scores
into probabilities, and each kind's threshold is the least probability at which
its held-out candidates reach the wanted precision, or those of all kinds where
a kind has few of them. A kind without any base span adds nothing.

Defined cases: NULL and empty texts have no spans; offsets are code points, end
exclusive; repeated rows and NULL doc_ids each keep their row; an empty table
gives no rows; added spans overlap neither base spans nor each other; further
columns are ignored by the report and kept by ``spans``.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeweave.llm.common import as_text, byte_view, cut, ship, slices, table

KINDS = ("email", "ip", "card", "phone")
#: Documents drawn for training, and candidates kept of them.
DRAWN, CANDIDATES = 4000, 20_000
TREES, DEPTH, BINS, RATE = 40, 3, 32, 0.3
PRECISION = 0.95
#: Held-out positives that a kind needs for a threshold of its own.
ENOUGH = 20
#: Characters of context on either side.
AROUND = 24
#: Ordinary numbers put in the place of each base span, as negatives.
ORDINARY = 6

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits starts a match or no place in it does, so only its start is tried.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: The generators.
_LOOSE = (
    ("email", re.compile(r"[A-Za-z0-9_%+-]{1,64}(?:\.[A-Za-z0-9_%+-]{1,64}){0,4} ?(?:@|\(at\)|\[at\]|\(@\)|\[@\]) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,63}){1,4}", re.I)),
    ("ip", re.compile(r"(?<![0-9])[0-9]{1,3}(?: ?(?:\.|\[\.\]|\(\.\)) ?[0-9]{1,3}){3}(?![0-9])")),
    ("card", re.compile(r"(?<![0-9])[0-9](?:[ .-]?[0-9]){11,18}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9])(?:\+|00 ?)?\(?[0-9]{1,4}\)?(?:[ ./()-]{1,2}[0-9]{2,5}){2,5}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9])(?:\+|00)?[0-9]{8,15}(?![0-9])")),
)

Span = tuple[int, int, int]  # kind, start, end


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def octets(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Checked pattern matches, by kind and start."""
    out = [(0, a, b) for a, b in emails(text)]
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if octets(m[0])]
    out += [(2, m.start(), m.end()) for m in _CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def candidates(text: str) -> list[Span]:
    """Overlapping proposals of all generators, without repeats."""
    return sorted({(KINDS.index(k), m.start(), m.end()) for k, p in _LOOSE for m in p.finditer(text)})


def loosened(text: str, span: Span) -> list[str]:
    """Loose forms of a base span that its pattern does not match."""
    kind, a, b = span
    s = text[a:b]
    if kind == 0:
        local, _, domain = s.rpartition("@")
        return [f"{local}{at}{domain.replace('.', dot)}" for at, dot in (("(at)", "."), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", "."), (" @ ", "."))]
    if kind == 1:
        return [s.replace(".", dot) for dot in ("[.]", "(.)", " . ")]
    if kind == 2:
        d = _digits(s)
        return [".".join(d[i:i + 4] for i in range(0, len(d), 4)), ".".join((d[:4], d[4:10], d[10:]))]
    d = re.sub(r"[ ().-]+", " ", s[1:]).strip()
    # a number without any mark of a phone number is no example of one
    return ["00" + s[1:], "00 " + d, *([s[1:]] if "(" in s else []), *([d.replace(" ", "/")] if " " in d else [])]


def _check13(digits: str) -> str:
    """The check digit of a 13-digit article or book number."""
    return str(-sum(int(c) * (1 + 2 * (i % 2)) for i, c in enumerate(digits)) % 10)


def ordinary(rng: random.Random) -> str:
    """A number, date or price as texts hold them, which is nobody's data."""
    n = lambda a, b=None: str(rng.randrange(10 ** (a - 1), 10 ** (b or a)))
    y, m, d = rng.randrange(1900, 2100), rng.randrange(1, 13), rng.randrange(1, 29)
    hms = f"{rng.randrange(24):02}{rng.randrange(60):02}{rng.randrange(60):02}"
    book = f"97{rng.choice('89')}{rng.randrange(10)}{n(8)}"
    book += _check13(book)
    page = rng.randrange(1, 900)
    kind = rng.randrange(16)
    if kind == 0:
        return f"{y}-{m:02}-{d:02}"
    if kind == 1:
        return f"{d:02}{rng.choice('./-')}{m:02}{rng.choice('./-')}{y}"
    if kind == 2:
        return f"{y}-{m:02}-{d:02}{rng.choice(' T')}{hms[:2]}:{hms[2:4]}:{hms[4:]}"
    if kind == 3:
        return f"{y}{m:02}{d:02}" + rng.choice(("", hms, hms + n(3)))
    if kind == 4:
        return rng.choice((f"{book[:3]}-{book[3]}-{book[4:6]}-{book[6:12]}-{book[12]}", book, f"{book[:3]} {book[3]} {book[4:8]} {book[8:12]} {book[12]}"))
    if kind == 5:
        return n(1, 3) + "." + n(3, 15)
    if kind == 6:
        return rng.choice(" .").join([n(1, 3), *(f"{rng.randrange(1000):03}" for _ in range(rng.randrange(1, 5)))])
    if kind == 7:
        return " ".join(f"{page + 20 * i}-{page + 20 * i + rng.randrange(1, 15)}" for i in range(rng.randrange(1, 4)))
    if kind == 8:
        return " ".join(n(4) for _ in range(rng.randrange(2, 5)))
    if kind == 9:
        return " ".join(n(1, 4) for _ in range(rng.randrange(2, 7)))
    if kind == 10:
        return f"{y}-{y + rng.randrange(1, 30)}"
    if kind == 11:
        return f"{rng.choice(('apples', 'seats', 'room'))} @ {n(1, 2)}.{n(2)}"
    if kind == 12:  # a card's form, but not its check digit
        c = n(15)
        c += next(x for x in "0123456789" if not luhn(c + x))
        return ".".join(c[i:i + 4] for i in range(0, 16, 4))
    if kind == 13:
        return ".".join(n(1, 2) for _ in range(rng.choice((3, 5)))) + rng.choice(("", "-" + n(3, 5)))
    if kind == 14:
        return "-".join((n(3, 4), n(3, 5), n(2, 5)))
    return n(8, 16)


def examples(text: str) -> Iterator[tuple[Span, bool, list[float]]]:
    """Training candidates of a text: span, label and features."""
    base = base_spans(text)
    for c in candidates(text):
        if not overlaps(c, base):
            yield c, False, described(text, c)
    reach = 4 * AROUND  # context that features and neighbouring groups can see
    for kind, a, b in base:
        lo, hi = max(0, a - reach), b + reach
        for form in dict.fromkeys(loosened(text, (kind, a, b))):
            near = text[lo:a] + form + text[b:hi]
            span = (kind, a - lo, a - lo + len(form))
            others = base_spans(near)
            if overlaps(span, others):
                continue
            for c in candidates(near):
                if overlaps(c, [span]) and not overlaps(c, others):
                    yield (c[0], c[1] + lo, c[2] + lo), c == span, described(near, c)
        rng = random.Random(zlib.crc32(text[lo:hi].encode("utf-8", "replace")) + a)
        for _ in range(ORDINARY):
            form = ordinary(rng)
            near = text[lo:a] + form + text[b:hi]
            span, others = (kind, a - lo, a - lo + len(form)), base_spans(near)
            for c in candidates(near):
                if overlaps(c, [span]) and not overlaps(c, others):
                    yield (c[0], c[1] + lo, c[2] + lo), False, described(near, c)


def _side(c: str) -> int:
    return 0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4


def described(text: str, span: Span) -> list[float]:
    """Format, check and context features."""
    kind, a, b = span
    s = text[a:b]
    groups = [len(g) for g in re.findall(r"[0-9]+", s)] or [0]
    marks = re.sub(r"[A-Za-z0-9]", "", s)
    left, right = text[max(0, a - AROUND):a], text[b:b + AROUND]
    near = left + right
    d = _digits(s)
    parts = re.findall(r"[0-9]+", s)
    year = next((float(1900 <= int(g) < 2100) for g in (parts[:1] + parts[-1:] + [d[:4]]) if len(g) == 4 and 1900 <= int(g) < 2100), 0.0)
    checks = [float(13 <= len(d) <= 19 and luhn(d)), float(len(parts) == 4 and all(int(g) <= 255 for g in parts)), float(9 <= len(d) <= 15),
              float(len(d) == 13 and d[:2] == "97" and _check13(d[:12]) == d[12]), year, float(len(parts) > 1 and all(len(g) == 3 for g in parts[1:])),
              float(s[:2] == "00"), float(len(set(map(len, parts))) == 1), float(sum(c in "([" for c in s)), float(re.split(r"[^A-Za-z0-9]+", s)[-1].isalpha())]
    return [kind, len(s), sum(groups), len(groups), max(groups), min(groups), groups[-1], len(marks), len(set(marks)), marks.count(" "), marks.count("."),
            marks.count("-"), marks.count("("), marks.count("@"), float(s[0] == "+"), sum(c.isalpha() for c in s), _side(left[-1:]), _side(right[:1]),
            sum(c.isdigit() for c in near), sum(c.isupper() for c in near), sum(not c.isalnum() and not c.isspace() for c in near), float("=" in left[-4:]), *checks]


class BoostedTrees:
    """Logistic gradient boosting over binned features, with an isotonic map
    from score to probability and a threshold for each kind."""

    def __init__(self, x: np.ndarray, y: np.ndarray, held: np.ndarray):
        self.trees: list = []
        self.cutoffs = np.full(len(KINDS), np.inf)
        self.steps = (np.zeros(1), np.zeros(1))
        if not len(x):
            return
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        bins, fit = self.binned(x), ~held
        self.start = float(np.log((y[fit].sum() + 1) / ((1 - y[fit]).sum() + 1)))
        raw = np.full(len(x), self.start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-raw))
            tree = self._grow(bins, y - p, p * (1 - p), np.flatnonzero(fit), DEPTH)
            self.trees.append(tree)
            raw += RATE * self._walk(tree, bins)
        self._calibrate(raw[held], y[held], x[held, 0], set(x[y > 0, 0].astype(int).tolist()))

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T)], 1)

    def _grow(self, bins, grad, hess, rows, depth):
        g, h = grad[rows].sum(), hess[rows].sum()
        leaf, best = g / (h + 1), (1e-3, None)
        if depth and len(rows) >= 10:
            for f in range(bins.shape[1]):
                many = len(self.edges[f]) + 1
                left_g = np.cumsum(np.bincount(bins[rows, f], grad[rows], many))[:-1]
                left_h = np.cumsum(np.bincount(bins[rows, f], hess[rows], many))[:-1]
                gain = left_g**2 / (left_h + 1) + (g - left_g) ** 2 / (h - left_h + 1) - g * g / (h + 1)
                if len(gain) and gain.max() > best[0]:
                    best = float(gain.max()), (f, int(gain.argmax()))
        if best[1] is None:
            return leaf
        f, at = best[1]
        low = bins[rows, f] <= at
        return f, at, self._grow(bins, grad, hess, rows[low], depth - 1), self._grow(bins, grad, hess, rows[~low], depth - 1)

    def _walk(self, tree, bins):
        if not isinstance(tree, tuple):
            return np.full(len(bins), tree)
        f, at, low, high = tree
        return np.where(bins[:, f] <= at, self._walk(low, bins), self._walk(high, bins))

    def _calibrate(self, raw, y, kind, known):
        """Pool adjacent violators, then the least sure probability of each
        kind, and that of all kinds for a ``known`` kind with few positives."""
        order = np.argsort(raw, kind="stable")
        blocks: list[list[float]] = []
        for s, t in zip(raw[order], y[order]):
            blocks.append([t, 1.0, s])
            while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
                t1, n1, s1 = blocks.pop()
                blocks[-1] = [blocks[-1][0] + t1, blocks[-1][1] + n1, s1]
        if not blocks:
            return
        self.steps = (np.array([b[2] for b in blocks]), np.array([b[0] / b[1] for b in blocks]))
        p = self._probability(raw)
        for k in known:
            mine = kind == k
            if y[mine].sum() < ENOUGH:
                mine = np.ones(len(y), bool)
            for cutoff in np.unique(p[mine]):
                if y[mine & (p >= cutoff)].mean() >= PRECISION:
                    self.cutoffs[k] = max(float(cutoff), 1e-9)
                    break

    def _probability(self, raw):
        return self.steps[1][np.minimum(np.searchsorted(self.steps[0], raw), len(self.steps[1]) - 1)]

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not self.trees:
            return np.zeros(len(x))
        bins = self.binned(x)
        return self._probability(self.start + RATE * sum(self._walk(t, bins) for t in self.trees))


def overlaps(span: Span, others: list[Span]) -> bool:
    return any(span[1] < e and s < span[2] for _, s, e in others)


def all_spans(text: str, model: BoostedTrees) -> tuple[list[Span], list[Span]]:
    """(base, added) spans of a text."""
    base = base_spans(text)
    covered = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in covered]
    reach = np.maximum.accumulate([b for _, b in covered]) if covered else np.zeros(0)
    free = lambda c: (i := int(np.searchsorted(starts, c[2]))) == 0 or reach[i - 1] <= c[1]
    loose = [c for c in candidates(text) if np.isfinite(model.cutoffs[c[0]]) and free(c)]
    if not loose:
        return base, []
    p = model.probability(np.array([described(text, c) for c in loose], float))
    added: list[Span] = []
    taken = np.zeros(len(text) + 1, bool)
    for i in np.lexsort(([c[1] for c in loose], -p)):
        k, a, b = loose[i]
        if p[i] >= model.cutoffs[k] and not taken[a:b].any():
            taken[a:b] = True
            added.append(loose[i])
    return base, added


#: Bytes without which no pattern and no generator matches.
_HINT = np.zeros(256, bool)
_HINT[[*range(0x30, 0x3A), ord("@"), ord("("), ord("[")]] = True


def hinted(column) -> Iterator[tuple[int, str]]:
    """(row, text) of the rows of an Arrow text column that hold a hint."""
    texts = as_text(column)
    data, offs = byte_view(texts)
    for i, j in slices(offs):
        at = np.flatnonzero(_HINT[data[offs[i]:offs[j]]]) + offs[i]
        for row in np.unique(np.searchsorted(offs, at, "right") - 1).tolist():
            yield row, texts[row].as_py()


def drawn_ids(docs: DataFrame, drawn: int) -> DataFrame:
    """(doc_id) of at most ``drawn`` documents: an equal share from those with
    a base span of each kind, and from those with any other candidate."""
    def mask(batches):
        for b in batches:
            ids, out = b.column(0), []
            for row, text in hinted(b.column(1)):
                base = base_spans(text)
                held = sum(1 << k for k in {s[0] for s in base}) | (any(not overlaps(c, base) for c in candidates(text)) << len(KINDS))
                if held:
                    out.append((ids[row].as_py(), held))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["doc_id", "held"])

    found = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text").mapInArrow(mask, "doc_id bigint, held bigint")
    found = cut(found, "candidate-docs")
    parts = [found.where(F.col("held").bitwiseAND(F.lit(1 << k)) != 0).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(drawn // (len(KINDS) + 1))
             for k in range(len(KINDS) + 1)]
    return reduce(DataFrame.unionByName, parts).distinct()


def train(docs: DataFrame, drawn: int = DRAWN, most: int = CANDIDATES) -> BoostedTrees:
    """Fit on the examples of ``drawn`` documents, ``most`` of them at most."""
    ship(docs.sparkSession)

    def propose(batches):
        for b in batches:
            ids, rows = b.column(0), []
            for row, text in hinted(b.column(1)):
                rows += [(ids[row].as_py(), *c, y, x) for c, y, x in examples(text)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.float64())))], names=["id", "kind", "a", "b", "y", "x"])

    picked = docs.select("doc_id", "text").join(F.broadcast(drawn_ids(docs, drawn)), "doc_id", "left_semi")
    order = ("id", "a", "b", "kind", "y", "x")
    rows = (picked.mapInArrow(propose, "id bigint, kind bigint, a bigint, b bigint, y boolean, x array<double>")
            .orderBy(F.xxhash64(*order), *order).limit(most).collect())
    x = np.array([r.x for r in rows], float).reshape(len(rows), -1 if rows else 0)
    held = np.array([(r.id * 2654435761 >> 7) % 3 == 0 for r in rows], bool)
    return BoostedTrees(x, np.array([r.y for r in rows], float), held)


def spans(docs: DataFrame, text_col: str = "text", model: BoostedTrees | None = None) -> DataFrame:
    """``docs`` with ``base`` and ``added``: arrays of (kind, start, end)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs.withColumn("text", F.col(text_col))))
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
    docs = docs.drop("base", "added")
    names = "array<struct<kind:int,start:int,end:int>>"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", base {names}, added {names}"

    def run(batches):
        trees = shared.value
        for b in batches:
            base: list[list[dict]] = [[] for _ in range(b.num_rows)]
            added: list[list[dict]] = [[] for _ in range(b.num_rows)]
            for row, text in hinted(b.column(b.schema.get_field_index(text_col))):
                for out, got in zip((base, added), all_spans(text, trees)):
                    out[row] = [dict(zip(("kind", "start", "end"), s)) for s in got]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(base, kind), pa.array(added, kind)], names=[*b.schema.names, "base", "added"])

    return docs.mapInArrow(run, schema)


def redacted(docs: DataFrame, text_col: str = "text", model: BoostedTrees | None = None) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets."""
    found = spans(docs.withColumn("_p_text", F.col(text_col)), "_p_text", model)
    every = F.array_sort(F.concat("base", "added"), lambda x, y: F.when(x["start"] != y["start"], x["start"] - y["start"]).otherwise(y["end"] - x["end"]))
    state = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    done = F.aggregate(every, state, lambda s, x: F.when(x["start"] < s["at"], F.struct(s["text"].alias("text"), F.greatest(s["at"], x["end"]).alias("at")))
                       .otherwise(F.struct(F.concat(s["text"], F.substring(F.col("_p_text"), s["at"] + 1, x["start"] - s["at"]), names[x["kind"]]).alias("text"),
                                           x["end"].alias("at"))))
    rest = F.substring(F.col("_p_text"), F.col("_p_done.at") + 1, F.length("_p_text"))
    return (found.withColumn("_p_done", done).withColumn(text_col, F.concat(F.col("_p_done.text"), rest)).select(docs.columns))


def report(docs: DataFrame) -> DataFrame:
    """Per document: base spans by kind, their digest, and all spans."""
    def written(rows):
        return ",".join(f"{KINDS[s['kind']]}:{s['start']}:{s['end']}" for s in sorted(rows, key=lambda s: (s["kind"], s["start"], s["end"])))

    schema = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"

    def digest(batches):
        for b in batches:
            base, added = b.column(1).to_pylist(), b.column(2).to_pylist()
            counts = [pa.array([sum(s["kind"] == k for s in r) for r in base], pa.int64()) for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays([b.column(0), *counts, pa.array([hashlib.sha256(written(r).encode()).hexdigest() for r in base]),
                                              pa.array([written(r + a) for r, a in zip(base, added)])], names=[x.split()[0] for x in schema.split(", ")])

    return spans(docs.select("doc_id", "text")).select("doc_id", "base", "added").mapInArrow(digest, schema)


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))


QUERIES = {"op9_personal_data": op9_personal_data}
ORACLE: dict[str, str] = {}
