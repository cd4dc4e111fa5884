"""Personal data: patterns, and a character BiLSTM-CRF that adds what they miss.

The network reads all of every text, in windows of WINDOW code points that overlap by OVERLAP; an address
too long for the overlap (up to LOCAL characters of name and HOST of host) has a window of its own. It
knows the patterns' four kinds and a fifth, secrets (keys and tokens that are assigned to a name),
for which there is no pattern. It is trained on passages of a bounded sample of texts, labelled by the
patterns, and on passages into which items of other layouts are written. The spans of all windows of a text are
reconciled at once: a span cut by its window's edge is left to the neighbour, and of overlapping
ones the set with the greatest sum of certainty stays. An added span has to pass the checks of its
kind and must not touch a pattern's span.

Defined cases: null and empty texts have no spans; offsets are code points; rows are independent, so
ties and repeated rows give repeated results; an empty table gives an empty one (the network then has made-up passages only);
other columns are not read. The sample is, of the texts with a digit or at-sign and of all texts, the
`sample` rows each with the smallest id hash, and of each PASSAGE code points around a place that the
hash chooses (the first digit or at-sign behind it for the former).
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import span_net
from .span_net import KINDS

SAMPLE = 300
#: Code points of a training passage, and of the pieces it is cut into.
PASSAGE, PIECE = 300, 96
#: Passages into which items are written.
MADE = 5000
STEPS = 1800
WINDOW, OVERLAP = 512, 64
#: Code points that are decoded at a time.
TOGETHER = 1 << 19
CERTAIN = 0.5
SEED = 11

#: The patterns. Possessive runs and the look-behind only keep them linear.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
#: Where an added address can reach: at most LOCAL characters of its name and HOST of its host stand around the sign.
LOCAL, HOST = 64, 512
_SIGN = re.compile(r"@|\(at\)|\[at\]")
#: A name, an equals sign or colon, and a value in or without quotes.
_ASSIGNED = re.compile(r"(?i:token|secret|passwd|password|key|auth)[\x20]?[=:][\x20]?[\"']?([A-Za-z0-9+/_=.-]{16,})")
_HOST = re.compile(r" ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)*+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
    return total % 10 == 0


def _ip_ok(s: str) -> bool:
    return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in s.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """kind, start, end of the patterns' spans, by kind and start."""
    out = []
    end, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > end and text[first - 1] in _LOCAL:
            first -= 1
        if first < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((0, first, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    n_digits = sum(map(text.count, "0123456789"))  # far cheaper than the patterns, which need four and sixteen
    out += [(1, *m.span()) for m in (_IP.finditer(text) if n_digits >= 4 else ()) if _ip_ok(m.group())]
    for m in _CARD.finditer(text) if n_digits >= 16 else ():
        if m.end() - m.start() >= 16 and 16 <= len(digits := "".join(_DIGITS.findall(m.group()))) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_DIGITS.findall(m.group())) <= 15]
    return out


def plausible(kind: int, s: str) -> bool:
    """What an added span must be."""
    digits = "".join(_DIGITS.findall(s))
    if kind == 0:
        return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]+(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]+)+", s))
    if kind == 1:
        return bool(re.fullmatch(r"[0-9]{1,3}(?: ?(?:\[\.\]|\(\.\)|\.) ?[0-9]{1,3}){3}", s)) and all(int(x) <= 255 for x in re.findall("[0-9]+", s))
    if kind == 2:
        return bool(re.fullmatch(r"[0-9](?:[\x20./-]?[0-9])+", s)) and 15 <= len(digits) <= 19 and luhn(digits)
    if kind == 4:
        return bool(re.fullmatch(r"[A-Za-z0-9+/_=.-]{16,}", s)) and len(digits) * 8 >= len(s) and len(re.findall("[A-Za-z]", s)) * 8 >= len(s)
    return bool(re.fullmatch(r"(?:\+|00|0)?[0-9(][0-9\x20()./-]+[0-9]", s)) and 9 <= len(digits) <= 15 and len(re.findall(r"[\x20()./-]+", s)) >= 2 and not re.fullmatch(r"[0-9]+(?:\.[0-9]+)+|(?:19|20)[0-9]{2}[-/.].*", s)


def windows_of(text: str) -> list[tuple[int, int]]:
    """Overlapping windows over all of the text, each of at most WINDOW code points.

    An address that no window holds with a margin gets one of its own, as wide as it is.
    """
    if not text:
        return []
    step = WINDOW - OVERLAP
    out = [(k, min(len(text), k + WINDOW)) for k in range(0, max(1, len(text) - OVERLAP), step)]
    for m in _SIGN.finditer(text):
        first = m.start() - (text[m.start() - 1 : m.start()] == " ")
        least = max(0, first - LOCAL)
        while first > least and text[first - 1] in _LOCAL:
            first -= 1
        host = _HOST.match(text, m.end(), m.end() + HOST)
        if host:
            first, last = max(0, first - 8), min(len(text), host.end() + 8)
            near = first // step
            if last - first > OVERLAP and not any(a <= first and last <= b for a, b in out[max(0, near - 1) : near + 1]):
                out.append((first, last))
    return out


def _number(rng: np.random.Generator, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def _card(rng: np.random.Generator, n: int) -> str:
    body = str(rng.integers(3, 7)) + _number(rng, n - 2)
    return next(body + str(d) for d in range(10) if luhn(body + str(d)))


_LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "0123456789")
#: Names to which made-up secrets are assigned.
_NAMES = ("token", "api_key", "apikey", "secret", "password", "access_key", "auth", "key", "API_TOKEN", "SECRET_KEY")


def _made(rng: np.random.Generator, kind: int | None = None) -> tuple[int, str]:
    """A made-up item: its kind (-1: none) and how it is written."""
    word = lambda n: "".join(chr(97 + c) for c in rng.integers(0, 26, n))
    pick = lambda *x: x[rng.integers(0, len(x))]
    kind = int(rng.integers(-3, 5)) if kind is None else kind
    if kind == 0:
        at, dot = pick("@", "@", " @ ", "(at)", " (at) ", "[at]", " [at] "), pick(".", ".", ".", " . ", "[dot]", " [dot] ", "(dot)", " (dot) ")
        if at == " @ " and dot == " . ":
            dot = "."
        long = int(rng.random() < 0.1) * 24
        name = ".".join(word(rng.integers(2, 9 + long)) for _ in range(int(rng.integers(1, 4)))) + pick("", "", "_" + word(3), _number(rng, rng.integers(1, 4)))
        host = dot.join([word(rng.integers(3, 8 + long)) + pick("", "", _number(rng, 1)), *(word(rng.integers(2, 10)) for _ in range(int(rng.integers(0, 3)))), pick("com", "org", "net", "de")])
        return 0, name + at + host
    if kind == 1:
        return 1, pick(".", ".", ".", "[.]", " . ").join(str(rng.integers(0, 256)) for _ in range(4))
    if kind == 2:
        c, sep = _card(rng, 16), pick("", "", " ", "-", ".")
        return (2, sep.join(c[k : k + 4] for k in range(0, 16, 4))) if rng.random() < 0.8 else (2, (lambda a: f"{a[:4]} {a[4:10]} {a[10:]}")(_card(rng, 15)))
    if kind == 3:
        a, b, c = _number(rng, 3), _number(rng, 3), _number(rng, 4)
        return 3, pick(f"+{rng.integers(1, 99)} ({a}) {b}-{c}", f"+{rng.integers(1, 99)} {a} {b} {c}", f"+{rng.integers(1, 99)}{a}{b}{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"0{rng.integers(100, 999)}/{b} {c}", f"00{rng.integers(10, 99)} {a} {b}{c}")
    if kind == 4:
        return 4, "".join(pick(*_LETTERS[pick(0, 1)]) for _ in range(int(pick(20, 24, 32, 40, 40, 64)))) if rng.random() < 0.4 else "".join(pick(*"0123456789abcdef") for _ in range(int(pick(32, 40, 40, 64))))
    return -1, pick(_number(rng, rng.integers(1, 13)), f"{rng.integers(0, 20)}.{rng.integers(0, 20)}", f"{rng.integers(1990, 2030)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}", f"{rng.integers(1, 999)},{_number(rng, 3)}", f"v{rng.integers(1, 9)}.{rng.integers(1, 20)}.{rng.integers(1, 20)}", "".join(pick(*"0123456789abcdef") for _ in range(int(rng.integers(8, 41)))), f"{_number(rng, 2)}:{_number(rng, 2)}", f"@{word(6)}", f"{_number(rng, 4)} {word(4)} {_number(rng, 4)}")


def training_windows(texts: list[str], seed: int = SEED) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Labelled windows: the patterns' spans in the texts, and made-up items written into them."""
    rng = np.random.default_rng(seed)
    texts = [t for t in texts if t] or ["the quick brown fox jumps over the lazy dog and runs away. " * 3]

    def tagged(text: str, spans: list[tuple[int, int, int]], first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        tags = np.zeros(last - first, dtype=np.int64)
        for kind, a, b in spans:
            if a >= first and b <= last:
                tags[a - first : b - first] = 2 * kind + 2
                tags[a - first] = 2 * kind + 1
        return span_net.codes(text[first:last]), tags

    rows = []
    for text in texts:
        spans = [*base_spans(text), *((4, *m.span(1)) for m in _ASSIGNED.finditer(text) if plausible(4, m.group(1)))]
        for a in range(0, max(1, len(text) - PIECE // 2), PIECE // 2):
            b = min(len(text), a + PIECE)
            if not any(x < a < y or x < b < y for _, x, y in spans):
                rows.append(tagged(text, spans, a, b))
    for k in range(MADE):  # addresses, which have the most layouts, and secrets are over a quarter each
        host = re.sub(r"[0-9@]", "", texts[rng.integers(0, len(texts))])
        cut = int(rng.integers(0, len(host) + 1))
        kind, item = _made(rng, {0: 0, 1: 4}.get(k % 4))
        before, after = host[max(0, cut - 30) : cut].rsplit(" ", 1)[0] + " ", " " + host[cut : cut + 30].split(" ", 1)[-1]
        if kind == 4:
            quote = ("", '"', "'")[rng.integers(0, 3)]
            before += _NAMES[rng.integers(0, len(_NAMES))] + (" = ", "=", ": ", ":", " = ")[rng.integers(0, 5)] + quote
            after = quote + after
        elif rng.random() < 0.2:  # junk that clings to words clings to items too
            after = ("!!", "###", "$$$", "%%%", "&&&", "***", ",", ".", ";")[rng.integers(0, 9)] + after
        text = before + item + after
        rows.append(tagged(text, [(kind, len(before), len(before) + len(item))] if kind >= 0 else [], 0, len(text)))
    return [w for w, _ in rows if len(w)], [t for w, t in rows if len(w)]


def passages(documents: DataFrame, id_col: str, text: str, sample: int) -> list[str]:
    """Training passages: at most `sample` of texts with a digit or at-sign, and as many of any."""
    h = F.xxhash64(F.col(id_col), F.lit(SEED))
    size = F.length(text)
    rows = documents.where(size > 0).select(h.alias("h"), F.col(text).alias("t"), (F.pmod(h, size) + 1).cast("int").alias("place"))
    trigger = F.lit("[0-9@]")
    behind = F.regexp_instr(F.substring("t", F.col("place"), F.length("t")), trigger)
    at = F.when(behind > 0, F.col("place") + behind - 1).otherwise(F.regexp_instr("t", trigger))

    def some(df: DataFrame, at: Column) -> DataFrame:
        part = F.substring("t", F.greatest(at - PASSAGE // 2, F.lit(1)), F.lit(PASSAGE))
        return df.select("h", part.alias("part")).orderBy("h", "part").limit(sample)

    both = some(rows.where(F.rlike("t", trigger)), at).unionByName(some(rows, F.col("place")))
    return [r["part"] for r in both.orderBy("h", "part").collect()]


def fit(documents: DataFrame, id_col: str = "doc_id", text: str = "text", sample: int = SAMPLE, steps: int = STEPS) -> dict:
    """The network's parameters; trained on the driver from at most 2 * sample passages."""
    return span_net.train(*training_windows(passages(documents, id_col, text, sample)), steps=steps)


def reconcile(spans: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
    """The non-overlapping subset with the greatest sum of certainty."""
    spans = sorted(set(spans), key=lambda s: (s[2], s[1], s[0], -s[3]))
    ends = [s[2] for s in spans]
    best: list[float] = [0.0]
    take = []
    for k, s in enumerate(spans):
        before = bisect.bisect_right(ends, s[1], 0, k)
        with_it = best[before] + s[3] + 1e-6 * (s[2] - s[1])
        take.append((with_it > best[k], before))
        best.append(max(best[k], with_it))
    out, k = [], len(spans)
    while k:
        chosen, before = take[k - 1]
        if chosen:
            out.append(spans[k - 1])
            k = before
        else:
            k -= 1
    return out[::-1]


def added_spans(p: dict, texts: list[str], bases: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int, float]]]:
    """Spans of the network for each text, reconciled over its windows."""
    places = [(k, a, b) for k, t in enumerate(texts) for a, b in windows_of(t)]
    coded = [span_net.codes(t) for t in texts]
    places.sort(key=lambda x: x[2] - x[1])
    held: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
    for (k, a, b), spans in zip(places, span_net.decode(p, [coded[k][a:b] for k, a, b in places], TOGETHER), strict=True):
        for kind, s, e, sure in spans:
            cut = (s == 0 and a > 0) or (e == b - a and b < len(texts[k]))
            if not cut and sure >= CERTAIN and plausible(kind, texts[k][a + s : a + e]):
                held[k].append((kind, a + s, a + e, sure))
    out = []
    for spans, base in zip(held, bases, strict=True):
        if spans:
            taken = sorted((a, b) for _, a, b in base)
            starts = [a for a, _ in taken]
            reach = np.maximum.accumulate([b for _, b in taken]) if taken else []
            free = []
            for s in spans:
                before = bisect.bisect_left(starts, s[2])
                if not before or reach[before - 1] <= s[1]:
                    free.append(s)
            spans = reconcile(free)
        out.append(spans)
    return out


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("certainty", T.DoubleType()), T.StructField("base", T.BooleanType())])


def find_spans(documents: DataFrame, p: dict, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id_col and spans, all spans of the text by kind and start."""
    shared = documents.sparkSession.sparkContext.broadcast(p)  # of fixed size
    schema = T.StructType([T.StructField(id_col, documents.schema[id_col].dataType), T.StructField("spans", T.ArrayType(SPAN))])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("certainty", pa.float64()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                texts = [t or "" for t in batch.column(1).slice(first, 1024).to_pylist()]
                bases = [base_spans(t) if t else [] for t in texts]
                rows = []
                for base, more in zip(bases, added_spans(shared.value, texts, bases), strict=True):
                    both = sorted([(k, a, b, 1.0, True) for k, a, b in base] + [(*s, False) for s in more], key=lambda s: (s[0], s[1]))
                    rows.append([{"kind": KINDS[k], "start": a, "end": b, "certainty": c, "base": is_base} for k, a, b, c, is_base in both])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, 1024), pa.array(rows, kind)], names=schema.names)

    return documents.select(F.col(id_col), F.col(text)).mapInArrow(run, schema)


def span_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digest of the patterns' spans, and all spans as one string."""

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == F.lit(kind)))).cast("long")

    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        id_col,
        *[count(k).alias(f"n_{k}") for k in KINDS[:4]],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"),
        F.size("spans").cast("long").alias("n_spans"),
    )
