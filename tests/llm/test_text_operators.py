"""Each operator against a brute-force version, the library, or an exact round trip."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from landweave.llm import bilinear, flat, importance, jaccard_join, license_rules, line_spread, media, piece_merge, private_spans, span_net, template_match, token_counts
from landweave.llm.queries import BYTE_BPE, PIECE_BPE, oracle_sql, queries, vocabulary

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK_WORDS = re.compile("[^\x20\x09-\x0d]+")
PLAIN_WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}


def words(text):
    return BLANK_WORDS.findall(text.translate(LOW))


def odd_texts(seed, n, parts, most=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(most))) for _ in range(n)]


def test_registered_queries():
    names = [n for n in queries() if n.startswith("op")]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14)) and "pipeline" in queries()


def test_flat_words_and_hashes_agree_with_python():
    rows = [*odd_texts(1, 300, [*"ab \n\té", "\xa0", "word", " "]), "", None]
    data, offsets = flat.column_bytes(pa.array(rows, pa.string()))
    seen, found = {}, []
    for first, last, part, at in flat.slices(data, offsets):
        starts, ends, index = flat.words(part, at)
        hashes = flat.word_hashes(part, starts, ends)
        for r in range(last - first):
            own = slice(index[r], index[r + 1])
            found.append([bytes(part[a:b]).decode() for a, b in zip(starts[own], ends[own], strict=True)])
            for w, h in zip(found[-1], hashes[own], strict=True):
                assert seen.setdefault(w, h) == h
    assert found == [BLANK_WORDS.findall(r or "") for r in rows]
    assert len(set(seen.values())) == len(seen)


# 1


def test_importance_separates_labelled_classes(spark):
    rng = random.Random(2)
    common = [f"w{k}" for k in range(60)]
    docs, labels = [], []
    for i in range(600):
        body = [rng.choice(common) for _ in range(60)]
        kind = i % 6
        if kind == 0:
            body = [f"{w}!!" for w in body]
        if kind == 1:
            body[10], body[40] = "rotten", "vilest"
        docs.append((i, " ".join(body)))
        labels.append((i, int(kind != 0), int(kind == 1)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = {r["doc_id"] for r in importance.keep(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    clean = {i for i in range(600) if i % 6 > 1}
    assert len(kept & clean) >= 0.95 * len(clean) and len(kept - clean) <= 0.05 * 200


def test_scores_match_a_loop(spark, documents, texts):
    rng = np.random.default_rng(0)
    quality, toxic = rng.normal(size=importance.WORD_BUCKETS).astype(np.float32), rng.normal(size=importance.BEGIN_BUCKETS).astype(np.float32)
    got = {r["doc_id"]: r for r in importance.score(documents.select("doc_id", "text").limit(30), "text", quality, toxic).collect()}

    def h(b):
        raw = np.frombuffer(b, np.uint8)
        return int(flat.word_hashes(raw, np.array([0]), np.array([len(raw)]))[0])

    for i, r in got.items():
        w = [x.encode() for x in BLANK_WORDS.findall(texts[i])]
        hs = np.array([h(x) for x in w], dtype=np.uint64)
        pairs = flat.windows(hs, 2)
        q = [quality[int(x) % importance.WORD_BUCKETS] for x in [*hs, *pairs]]
        t = [toxic[h(x.translate(bytes(flat.LOWER))[:4]) % importance.BEGIN_BUCKETS] for x in w]
        assert r["__n_words"] == len(w)
        assert r["__quality_ratio"] == pytest.approx(sum(map(float, q)) / max(1, 2 * len(w) - 1), abs=1e-9)
        assert r["__toxic_ratio"] == pytest.approx(sum(map(float, t)) / math.sqrt(max(1, len(w))), abs=1e-9)


def brute_importance(rows, labels, noise):
    """log weight of each id, all in dictionaries and loops; labels: id -> (class, half)."""
    one = lambda b: int(flat.word_hashes(np.frombuffer(b, np.uint8), np.array([0]), np.array([len(b)]))[0])
    grams, begins = {}, {}
    for i, t in rows:
        w = [x.encode() for x in BLANK_WORDS.findall(t or "")]
        hs = [one(x) for x in w]
        pairs = [int(flat.windows(np.array(hs[k : k + 2], dtype=np.uint64), 2)[0]) for k in range(len(hs) - 1)]
        grams[i] = [h % importance.WORD_BUCKETS for h in [*hs, *pairs]]
        begins[i] = [one(x.translate(bytes(flat.LOWER))[:4]) % importance.BEGIN_BUCKETS for x in w]
    raw, raw_begins = Counter(), Counter()
    for i, _ in rows:
        raw.update(grams[i])
        raw_begins.update(set(begins[i]))

    def ratio_tables(halves):
        good = [i for i, (c, h) in labels.items() if c == 1 and h in halves and i in grams]
        evil = [i for i, (c, h) in labels.items() if c == 2 and h in halves and i in grams]
        g, e = Counter(x for i in good for x in grams[i]), Counter(x for i in evil for x in set(begins[i]))
        share, part, s = sum(g.values()) / sum(raw.values()), len(evil) / len(rows), max(2.0, len(evil) / 400)
        q = {b: math.log((g[b] + 2.0) / (n * share + 2.0)) for b, n in raw.items()}
        t = {b: math.log((e[b] + s) / (n * part + s)) for b, n in raw_begins.items()}
        return q, {b: v if v > importance.TOXIC_RATIO else 0.0 for b, v in t.items()}

    def scores(i, tables):
        q, t = tables
        n = len(begins[i])
        return sum(q[b] for b in grams[i]) / max(1, len(grams[i])), sum(t[b] for b in begins[i]) / math.sqrt(max(1, n))

    crossed = {}
    for half in (0, 1):
        tables = ratio_tables({1 - half})
        crossed |= {i: (c, *scores(i, tables)) for i, (c, h) in labels.items() if h == half and i in grams}
    of = lambda c, k: np.array([s[k] for s in crossed.values() if s[0] == c])
    q, t = importance.calibrated(of(3, 1), of(1, 1)), importance.calibrated(of(2, 2), of(1, 2))
    both, weight = ratio_tables({0, 1}), {}
    for i, _ in rows:
        x, y = scores(i, both)
        good, not_toxic = q[0] * x + q[1], t[0] * y + t[1]
        weight[i] = 0.0 if not begins[i] else good if not y else -math.log(math.exp(-good) + math.exp(-not_toxic))
    k = sum(v >= 0 for v in weight.values())
    least = sorted((weight[i] + noise[i] for i in weight), reverse=True)[k - 1]
    return weight, {i for i in weight if weight[i] + noise[i] >= least}


def test_importance_matches_brute_force(spark, documents):
    from pyspark.sql import functions as F

    docs = documents.select("doc_id", "text").unionByName(spark.createDataFrame([(9001, None), (9002, ""), (9003, " \n")], "doc_id long, text string"))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    known = {r["__id"]: (r["__class"], r["__half"]) for r in importance.labelled_rows(labels).collect()}
    noise = {r[0]: r[1] for r in docs.select("doc_id", importance.gumbel(F.col("doc_id"))).collect()}
    weight, kept = brute_importance(rows, known, noise)
    got = {r["doc_id"]: r for r in importance.kept_scores(docs, labels).collect()}
    assert set(got) == kept and len(kept) < len(rows)
    for i, r in got.items():
        assert r["log_weight"] == pytest.approx(weight[i], abs=1e-4) and r["gumbel_key"] == pytest.approx(weight[i] + noise[i], abs=1e-4)
    assert weight[9001] == weight[9002] == weight[9003] == 0.0
    few = {r["doc_id"] for r in importance.keep(docs, labels, k=20).collect()}
    assert few == set(sorted(weight, key=lambda i: -(weight[i] + noise[i]))[:20])


def test_small_draws_are_of_better_quality(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    n = documents.count()
    mean = {k: np.mean([r["quality_ratio"] for r in importance.kept_scores(documents, labels, k=k).collect()]) for k in (n // 20, n // 4, n // 2)}
    assert mean[n // 20] > mean[n // 4] > mean[n // 2]
    top = importance.kept_scores(documents, labels).toPandas()["log_weight"].nlargest(40)
    assert top.nunique() > 30 and top.iloc[0] > top.iloc[-1] + 0.2


def test_calibration_finds_log_odds():
    rng = np.random.default_rng(3)
    slope, offset = importance.calibrated(rng.normal(-1, 1, 20000), rng.normal(1, 1, 20000))  # the true log odds are 2 x
    assert slope == pytest.approx(2, abs=0.1) and offset == pytest.approx(0, abs=0.1)
    assert importance.calibrated(np.zeros(0), np.ones(3)) is None


@pytest.mark.parametrize("k", [0, 1, 7, 500, 1000])
def test_kth_largest_by_histograms(spark, k):
    values = [float(int(v)) if i % 3 else float(v) for i, v in enumerate(np.random.default_rng(1).normal(0, 50, 1000))]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert importance.kth_largest(df, "v", k, bins=16) == (sorted(values, reverse=True)[k - 1] if k else float("inf"))


# 2


def brute_base(text):
    w = PLAIN_WORDS.findall(text.translate(LOW))
    found = [(k, label) for p, label in license_rules.BASE_PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
    at = [k for k, _ in found]
    return len(w), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def brute_labels(text):
    """Labels after suppression, pair by pair."""
    w = PLAIN_WORDS.findall(text.translate(LOW))
    norm = " " + " ".join(w) + " " if w else " "
    spans = []
    for p, keyword, regex, label in license_rules.rules():
        if f" {keyword}" in norm:
            for m in re.finditer(f"(?<= )(?:{regex})(?= )", norm):
                first = norm[: m.start()].count(" ") - 1
                spans.append((first, first + m.group().count(" "), p, label))
    kept = {s[3] for s in spans if not any(o is not s and o[0] <= s[0] and o[1] >= s[1] and (o[2] < s[2] or (o[2] == s[2] and (o[:2] != s[:2] or o[3] < s[3]))) for o in spans)}
    return ",".join(sorted(kept | {x for x in brute_base(text)[4].split(",") if x}))


LICENSE_TEXTS = [
    "Licensed under the Apache License, Version 2.0 (the License)",
    "under the MIT License. under  the\nMIT-license; MIT License",
    "SPDX-License-Identifier: GPL-3.0-or-later and CC BY-NC 4.0, see https://creativecommons.org/licenses/by-nc/4.0/",
    "GNU Lesser General Public License version 2.1 or the GNU General Public License, version 3",
    "you can redistribute it and/or modify it under the terms of the GNU General Public License as published",
    "released under the terms of the 3-clause BSD license, all rights reserved",
    "the summit licensed nothing; submit license forms",
    "cc by nc cc by nc cc by nc",
    "",
]


def test_license_scan(spark):
    rows = LICENSE_TEXTS + odd_texts(3, 200, ["under the ", "MIT ", "License ", "apache ", "version ", "2 ", "0 ", "cc-by", "-nc ", "gnu general public licence ", "é", "licensed ", ". "], 25)
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id int, text string")
    for r in license_rules.scan(df, "text").collect():
        text = rows[r["doc_id"]]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(text)
        assert r["labels"] == brute_labels(text)
        assert 0 <= r["score"] <= 1
    assert len(license_rules.rules()) > 200


def written(tree):
    """Texts that a rule's parsed regex matches: each alternative and each option of it taken once."""
    out = [""]
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            more = [chr(arg)]
        elif name == "IN":
            more = [chr(x[1] if str(x[0]) == "LITERAL" else x[1][0]) for x in arg]
        elif name == "SUBPATTERN":
            more = written(arg[3])
        elif name == "BRANCH":
            more = [x for part in arg[1] for x in written(part)]
        else:
            assert name == "MAX_REPEAT" and arg[1] == 1
            more = ["", *written(arg[2])]
        out = [a + b for a in out for b in more]
    return out


def test_license_gate_loses_no_match(spark):
    rules = license_rules.rules()
    for p, keyword, regex, _ in rules:
        if p != 2:  # grants end with a name, which has the same keyword
            assert all(f" {keyword}" in f" {x}" for x in written(re._parser.parse(regex))), regex
    rows = ["Licence: MIT", "Licence: GPL-3.0", "licence id apache-2.0", "0BSD", "this is 0BSD code", "licensed under 0bsd", "Zero clause BSD", "nothing"]
    want = []
    for text in rows:
        norm = " " + " ".join(PLAIN_WORDS.findall(text.translate(LOW))) + " "
        want.append({label for _, _, regex, label in rules if re.search(f"(?<= )(?:{regex})(?= )", norm)})
    assert want[0] == {"mit"} and {"bsd-0"} == want[3] == want[4]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id int, text string")
    for r in license_rules.scan(df, "text").collect():
        assert {d["label"] for d in r["detections"]} == want[r["doc_id"]] and (r["labels"] != "") == bool(want[r["doc_id"]])


# 3


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_queries_match_sql(spark, name):
    con = pytest.importorskip("duckdb").connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(oracle_sql()[name])
    got = queries()[name](spark, SF)
    assert got.columns == [c[0] for c in want.description]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want.fetchall(), key=key)


def test_near_threshold_lines_are_counted_exactly(spark):
    rows = [(k, f"site{k % n}", f"line on {n} sites") for n in (9, 10, 11, 40) for k in range(120)]
    df = spark.createDataFrame([(i, s, t) for i, (_, s, t) in enumerate(rows)], "doc_id long, source string, text string")
    found = line_spread.boilerplate(df, "doc_id", "text", "source", 10, lg_k=4).collect()
    assert sorted(r["sites"] for r in found)[:2] == [10, 11] and len(found) == 3


# 4


def test_base_scores_and_held_out_gain(spark, documents, texts):
    got = {r["doc_id"]: r for r in bilinear.score(documents).collect()}
    split = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    tokens = {i: [*words(t), None] for i, t in texts.items()}
    c = Counter(w for i, ws in tokens.items() if not split[i] for w in ws)
    n, v = sum(c.values()), len(c)
    base = model = count = 0.0
    for i, ws in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (split[i], len(ws), sum(c[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), rel=1e-9)
        if split[i]:
            base, model, count = base + r["base_score"], model + r["score"], count + len(ws)
    assert model - base > 0.1 * count


def odd_stream(size, seed):
    """Tokens where each of 300 classes is mostly followed by the next but one after the one before it."""
    rng = np.random.default_rng(seed)
    kind = rng.integers(0, 300, size)
    for k in range(2, size):
        if rng.random() < 0.8:
            kind[k] = (kind[k - 2] + 7) % 300
    return *bilinear.before(kind, np.array([0, size])), kind


def test_bilinear_probabilities_are_normalised_and_learn():
    two, one, kind = odd_stream(40_000, 0)
    counts = np.bincount(kind, minlength=bilinear.CLASSES).astype(float)
    start = bilinear.initial(counts)
    learner = bilinear.Learner(start, counts, 250)
    for first in range(0, 40_000, 999):
        learner.take(two[first : first + 999], one[first : first + 999], kind[first : first + 999])
    learner.finish()
    assert learner.steps == 160 and learner.seen == 40_000
    scorer = bilinear.Scorer(learner.p)
    for k in range(3):  # all classes after one context
        every = np.arange(bilinear.CLASSES)
        p = np.exp(scorer.of(np.full(bilinear.CLASSES, two[k]), np.full(bilinear.CLASSES, one[k]), every).astype(np.float64))
        assert p.sum() == pytest.approx(1, abs=1e-4)
    held = odd_stream(5000, 1)
    share, group = bilinear.shares(counts)
    plain = np.log(share[held[2]] * group[held[2] // bilinear.GROUP])
    assert np.allclose(bilinear.Scorer({**start, "qg": 0 * start["qg"], "q": 0 * start["q"]}).of(*held), plain, atol=1e-4)
    assert scorer.of(*held).mean() > plain.mean() + 1


def test_bilinear_gradients_agree_with_differences():
    rng = np.random.default_rng(2)
    two, one, kind = (x[:50] % bilinear.CLASSES for x in odd_stream(60, 3))
    kind[::7] = rng.integers(0, bilinear.CLASSES, len(kind[::7]))
    counts = rng.integers(0, 50, bilinear.CLASSES).astype(float)
    p = {k: v.astype(np.float64) + rng.normal(0, 0.05, v.shape) for k, v in bilinear.initial(counts).items()}
    share, group = bilinear.shares(counts)
    noise = rng.integers(0, bilinear.GROUP, (bilinear.GROUPS, 5)) + np.arange(bilinear.GROUPS)[:, None] * bilinear.GROUP
    given = (np.log(share), np.log(group), two, one, kind, rng.integers(0, bilinear.GROUPS, 6), noise)
    _, grads = bilinear.loss_and_gradients(p, *given)
    for name, g in grads.items():
        for at in (np.unravel_index(int(np.abs(g).argmax()), g.shape), tuple(int(rng.integers(0, d)) for d in g.shape)):
            loss = []
            for step in (1e-4, -1e-4):
                q = {k: v.copy() for k, v in p.items()}
                q[name][at] += step
                loss.append(bilinear.loss_and_gradients(q, *given)[0])
            assert g[at] == pytest.approx((loss[0] - loss[1]) / 2e-4, abs=1e-6)


def test_scores_are_those_of_the_model_token_by_token(spark, documents, texts):
    """The query's score against a loop over tokens with the trained parameters, each normalised over all classes."""
    training = documents.where(~bilinear.held_out("doc_id")).select("text")
    kept = {}
    was = bilinear.train
    bilinear.train = lambda *a: kept.setdefault("p", was(*a))
    try:
        got = {r["doc_id"]: r for r in bilinear.score(documents, rounds=1).collect()}
    finally:
        bilinear.train = was
    split = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    c = Counter(w for i, t in texts.items() if not split[i] for w in [*words(t), None])
    one = lambda w: int(flat.word_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w.encode())]))[0]) if w is not None else 1
    order = sorted(c, key=lambda w: (-c[w], one(w)))
    kinds = {w: k for k, w in enumerate(order[: bilinear.END_CLASS]) if w is not None}

    def kind(w):
        raw = (w or "").encode()
        return bilinear.END_CLASS if w is None else kinds[w] if w in kinds else bilinear.HEAD + raw[-1] % (bilinear.TAIL // 2) * 2 + (max(raw) >= 0x80)

    rest, sorts = Counter(), Counter()
    for w, n in c.items():
        rest[kind(w)] += n
        sorts[kind(w)] += 1
    p = {k: v.astype(np.float64) for k, v in kept["p"].items()}
    for i in sorted(texts)[:25]:
        total, a, b = 0.0, bilinear.END_CLASS, bilinear.END_CLASS  # a: two before
        for w in [*words(texts[i]), None]:
            k = kind(w)
            r = p["e"][b] @ p["c1"] + p["e"][a] @ p["c2"]
            groups, inside = np.exp(p["qg"] @ r + p["bg"]), np.exp(p["q"] @ r + p["b"])
            g = k // bilinear.GROUP
            total += math.log10(groups[g] / groups.sum() * inside[k] / inside[g * bilinear.GROUP : (g + 1) * bilinear.GROUP].sum())
            if k >= bilinear.HEAD:
                total += math.log10((c[w] + 0.1) / (rest[k] + 0.1 * (sorts[k] + 1)))
            a, b = b, k
        assert got[i]["score"] == pytest.approx(total, rel=1e-4)
    assert training.count() == sum(not x for x in split.values())


def test_repeated_passages_are_counted(spark):
    rng = random.Random(4)
    text = lambda k: " ".join(f"{k}w{rng.randrange(10**9)}" for _ in range(200))
    twice, part = text("a"), text("p")
    rows = [(i, text(f"x{i}")) for i in range(50)]
    rows += [(100, twice), (101, twice), (102, text("l") + " " + part), (103, part + " " + text("r")), (104, None)]
    got = {r["doc_id"]: r for r in bilinear.score(spark.createDataFrame(rows, "doc_id long, text string"), rounds=1).collect()}
    assert all(got[i]["n_repeated"] == 0 for i in [*range(50), 104])
    assert got[100]["n_repeated"] > 150 and got[101]["n_repeated"] > 150
    for i in (102, 103):
        assert 100 < got[i]["n_repeated"] <= 201


def test_rare_tokens_beyond_the_hot_table(spark, documents, monkeypatch):
    want = {r["doc_id"]: r for r in bilinear.score(documents, rounds=0).collect()}
    monkeypatch.setattr(bilinear.hot_tokens, "__defaults__", (5000,))
    got = {r["doc_id"]: r for r in bilinear.score(documents, rounds=0).collect()}
    for i, r in want.items():
        assert got[i]["n_known"] == r["n_known"] and got[i]["base_score"] == pytest.approx(r["base_score"], rel=1e-9)
        # fewer words have a class of their own, so scores are near, not equal
        assert got[i]["score"] == pytest.approx(r["score"], rel=1e-2) and got[i]["n_repeated"] == r["n_repeated"]


# 5

EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(text):
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 16 <= len(d := re.sub("[^0-9]", "", m.group())) <= 19 and private_spans.luhn(d)]
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_base_spans():
    parts = ["a", "@", ".", "b.c", "1", "12", "255", "256", "+", "-", " ", "(", ")", "4111", "1111", "é", "_", "%", "999"]
    for t in odd_texts(4, 20_000, parts, 30):
        assert private_spans.base_spans(t) == brute_spans(t)
    assert private_spans.base_spans("1" * 200_000 + "a" * 200_000) == []


def test_network_gradients_agree_with_differences():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in span_net.initial(1).items()}
    x = rng.integers(1, span_net.CODES, (7, 3))
    x[5:, 1] = 0
    tags = rng.integers(0, span_net.TAGS, (7, 3))
    _, grads = span_net.loss_and_gradients(p, x, tags)
    for name in p:
        at = (int(x[2, 0]), 3) if name == "embed" else tuple(int(rng.integers(0, d)) for d in p[name].shape)
        loss = []
        for step in (1e-3, -1e-3):
            q = {k: v.copy() for k, v in p.items()}
            q[name][at] += step
            loss.append(span_net.loss_and_gradients(q, x, tags)[0])
        assert grads[name][at] == pytest.approx((loss[0] - loss[1]) / 2e-3, abs=2e-4)


@pytest.fixture(scope="module")
def network(documents):
    return private_spans.fit(documents)


def test_fast_emissions_and_the_bound_lose_nothing(network, texts):
    rng = np.random.default_rng(5)
    rows = [t[k : k + 90] for t in texts.values() if t for k in rng.integers(0, len(t), 3)] + ["", "a"]
    coded = [span_net.codes(t) for t in rows if t]
    x = span_net.pad(coded, max(map(len, coded)))
    slow, *_ = span_net._emissions(network, x)
    fast = span_net.scan(network, x).transpose(0, 2, 1)
    assert np.abs(np.where(x[:, :, None] > 0, slow - fast, 0)).max() < 1e-3
    every = span_net._best_paths(network, np.ascontiguousarray(fast), x)
    found = span_net.decode(network, coded, together=2000)
    assert [[s[:3] for s in f] for f in found] == [[s[:3] for s in f] for f in every]
    assert len(span_net.hopeful(network, span_net.scan(network, x), x)) < len(coded)


def test_network_finds_other_layouts_and_base_stays(spark, network):
    host = "the words around it are plain and "
    items = {"email": "bob.12 (at) site.example.com", "card": "4111.1111.1111.1111", "phone": "(212) 555-0143", "ip": "10[.]20[.]30[.]40"}
    rng = random.Random(1)
    rows = [(k, f"{host}{v} then more words follow") for k, v in items.items()]
    clean = [("none", f"{host}{x} then more words follow") for x in ("12 items", "2024-01-02", "version 2.0", "1eb9c654e721b4f8", "1,250", "10:45")]
    df = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(rows + clean)], "doc_id int, kind string, text string")
    found = {r["doc_id"]: r["spans"] for r in private_spans.find_spans(df, network).collect()}
    hits = sum(any(s["kind"] == k and (s["start"], s["end"]) == (len(host), len(host) + len(items[k])) and not s["base"] for s in found[i]) for i, (k, _) in enumerate(rows))
    assert hits >= 2
    assert sum(bool(found[len(rows) + i]) for i in range(len(clean))) <= 1
    held, marked = private_spans.training_windows([host * 5], seed=rng.randrange(10**6))
    good = total = 0
    for tags, spans in zip(marked, span_net.decode(network, held), strict=True):
        for s in np.flatnonzero(tags % 2 == 1):
            total += 1
            good += any(a == s and 2 * k + 1 == tags[s] for k, a, _, _ in spans)
    assert good / total > 0.7


def test_addresses_without_digits_and_long_ones_are_found(spark, network):
    host = "the words around it are plain and "
    items = ["jane.doe [at] example [dot] com", "jane.doe(at)example.org", "maximilian.featherstonehaugh.smith (at) department.of.chemistry.example.com", "anna.holm (at) example (dot) org", "peter [at] somewhere.net"]
    for far in ("", "word " * 70, "word " * 75):
        for k in items:
            first, last = len(far + host), len(far + host) + len(k)
            assert any((a < first or a == 0) and last < b for a, b in private_spans.windows_of(far + host + k + " then more words follow"))
    df = spark.createDataFrame([(i, f"{host}{v} then more words follow") for i, v in enumerate(items)], "doc_id int, text string")
    found = {r["doc_id"]: r["spans"] for r in private_spans.find_spans(df, network).collect()}
    hits = [any(s["kind"] == "email" and (s["start"], s["end"]) == (len(host), len(host) + len(v)) for s in found[i]) for i, v in enumerate(items)]
    assert any(hits), hits
    assert max(b - a for a, b in private_spans.windows_of("a" * 100_000 + "@" + "b" * 100_000)) < 1000


def test_scan_looks_each_character_up_once_for_both_directions(network, monkeypatch):
    x = span_net.pad([span_net.codes("call +49 30 1234567 now"), span_net.codes("no")], 40)
    slow, *_ = span_net._emissions(network, x)
    calls, take = [], np.take
    monkeypatch.setattr(span_net.np, "take", lambda *a, **k: calls.append(1) or take(*a, **k))
    fast = span_net.scan(network, x).transpose(0, 2, 1)
    assert len(calls) == len(x) and np.abs(fast - slow)[x > 0].max() < 1e-3


def test_scan_takes_no_tanh_and_holds_where_exponentials_overflow(monkeypatch):
    x = span_net.pad([span_net.codes("call +49 30 1234567 now")], 23)
    for times in (1, 100):
        p = {k: v * times for k, v in span_net.initial(1).items()}
        slow, *_ = span_net._emissions({k: v.astype(np.float64) for k, v in p.items()}, x)
        with monkeypatch.context() as m:
            m.setattr(span_net.np, "tanh", None)  # of 32-bit floats twice as dear as exp
            fast = span_net.scan(p, x).transpose(0, 2, 1)
        assert np.abs(fast - slow).max() < 1e-3 * times


def test_patterns_of_digits_pass_texts_with_too_few(monkeypatch):
    assert private_spans.base_spans("x 1.2.3.4 y") == [(1, 2, 9)] and len(private_spans.base_spans("4111 1111 1111 1111")) == 1
    for pattern in ("_IP", "_CARD"):
        monkeypatch.setattr(private_spans, pattern, None)
    assert private_spans.base_spans("in 123 lines") == []


def test_span_query_matches_brute_force(spark, texts, network, monkeypatch):
    """The query, with the network that the other tests use: base counts and digests against plain patterns, and what may be added."""
    monkeypatch.setattr(private_spans, "fit", lambda documents: network)
    got = {r["doc_id"]: r for r in queries()["op5_private_spans"](spark, SF).collect()}
    names = span_net.KINDS
    assert set(got) == set(texts)
    for i, t in texts.items():
        base = sorted(brute_spans(t), key=lambda s: s[:2])
        r = got[i]
        assert [r[f"n_{k}"] for k in names[:4]] == [sum(s[0] == k for s in base) for k in range(4)]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{names[k]}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        spans = [(names.index(k), int(a), int(b)) for k, a, b in (x.split(":") for x in r["spans"].split(",") if x)]
        assert spans == sorted(spans, key=lambda s: s[:2]) and set(base) <= set(spans)
        more = sorted(set(spans) - set(base), key=lambda s: s[1])
        assert (r["n_added"], r["n_spans"]) == (len(more), len(spans))
        for k, a, b in more:
            assert private_spans.plausible(k, t[a:b]) and not any(x < b and a < y for _, x, y in base)
        assert all(x[2] <= y[1] for x, y in zip(more, more[1:], strict=False))
    # secrets have no pattern: what the network adds is most of them
    secrets = {i: re.findall('token = "([0-9a-f]{40})"', t) for i, t in texts.items()}
    wanted = [(i, s) for i, found in secrets.items() for s in found]
    caught = sum(any(texts[i][int(a) : int(b)] == s for k, a, b in (x.split(":") for x in got[i]["spans"].split(",") if x) if k == "secret") for i, s in wanted)
    assert not wanted or caught / len(wanted) >= 0.5


def test_every_character_lies_in_a_window():
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        parts = private_spans.windows_of("x" * n)
        assert {k for a, b in parts for k in range(a, b)} == set(range(n))
        assert all(b - a <= private_spans.WINDOW for a, b in parts)
        assert all(x[1] - y[0] >= private_spans.OVERLAP for x, y in zip(parts, parts[1:], strict=False))


def test_spans_of_overlapping_windows_are_reconciled():
    assert private_spans.reconcile([(0, 0, 5, 0.9), (1, 3, 9, 0.95), (2, 9, 12, 0.8), (0, 6, 9, 0.9)]) == [(0, 0, 5, 0.9), (0, 6, 9, 0.9), (2, 9, 12, 0.8)]


# 6


def test_token_counts_match_the_library(spark, documents, texts):
    tok = token_counts.tokenizer(vocabulary(BYTE_BPE))
    got = {r["doc_id"]: r for r in queries()["op6_token_counts"](spark, SF).collect()}
    for i, t in texts.items():
        n = len(tok.encode(t, add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len(t.encode()), n > 512)


def test_chunks_are_spliced_exactly(texts):
    tok = token_counts.tokenizer(vocabulary(BYTE_BPE))
    parts = ["'re", "<|endoftext|>", " ", "  ", "abc", "\n", " \n", "12", "don't", "'", "é", "\U0001f642", "\xa0", "\u2003", "\u200b", "_", "Ⅷ", "½", "\t"]
    rows = [*list(texts.values())[:100], *odd_texts(5, 600, parts, 300), "", "a" * 5000, " " * 3000, "<|endoftext|>" * 200, "a" * 3000 + " b" * 3000, "\n" * 4000 + "x"]
    want = [len(e.ids) for e in tok.encode_batch(rows, add_special_tokens=False)]
    for chunk, overlap in ((120, 34), (200, 100), (4096, 128)):
        assert token_counts.counts(tok, rows, chunk, overlap) == want


def test_most_text_goes_by_chunks(spark, documents, texts):
    """Every text over the chunk's size is spliced; the others are one chunk."""
    got = {r["doc_id"]: r["n_chunks"] for r in queries()["op6_token_counts"](spark, SF).collect()}
    for i, t in texts.items():
        assert got[i] == (0 if not t else 1 if len(t) <= token_counts.CHUNK_CHARS else math.ceil((len(t) - 128) / (4096 - 128)))
    assert sum(n > 1 for n in got.values()) > 20


# 7


def test_leaks_by_template(spark):
    item = "On Monday a farmer sold 12 km of rope to Peter for 30 dollars and kept 12 pieces for the winter market"
    other = item.replace("12", "77").replace("30", "45").replace("Peter", "Maria")
    mixed = item.replace("12 km", "77 km", 1).replace("30", "45")
    docs = [(1, f"Before it. {item} After it."), (2, f"Before it. {other} After it."), (3, f"Before it. {mixed} After it."), (4, "a farmer sold rope to the winter market"), (5, item.upper().replace("PETER", "peter"))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r for r in template_match.leaks(df, spark.createDataFrame([(9, item)], "item_id long, text string")).collect()}
    assert got[1]["coverage"] == 1.0 and not got[1]["reparameterised"]
    assert got[2]["reparameterised"] and 3 not in got and 4 not in got


def test_a_variant_before_the_item_hides_no_leak(spark):
    item = "a trader sells 12 red apples to Anna Holm and then sells 30 green pears to Peter for the winter market"
    variant = "a trader sells 99 red apples to Carla Berg and then sells 44 green pears"
    gap = item.replace("and then", "and only then")
    docs = [(1, f"{variant} there. {item} at last."), (2, f"{item} first. {variant} there."), (3, f"{variant} there. {gap} at last."), (4, item.replace("12", "12 12"))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r for r in template_match.leaks(df, spark.createDataFrame([(9, item)], "item_id long, text string")).collect()}
    assert got[1]["coverage"] == got[2]["coverage"] == 1.0 and not got[1]["reparameterised"] and not got[2]["reparameterised"]
    assert 3 in got and 4 in got


def test_items_dense_in_numbers_leak_by_their_values(spark):
    items = ["What is 12 + 30 * 45 - 61 / 7 + 9 - 14 + 3 + 8?", "Table 1 2 3 4 rows 5 6 7 8 sum 36 37", "52 30 45 61 7 9 14 3", "the red fox and the grey cat ran to 1 2 3 4 5 6 7 8 9 10 11 12"]
    other = ["What is 13 + 31 * 46 - 62 / 8 + 10 - 15 + 4 + 9?", "13 31 46 62 8 10 15 4"]
    half = items[3].replace(" 7 8 9 10 11 12", " 70 80 90 100 110 120")
    df = spark.createDataFrame([(k, f"Some words. {t} More words.") for k, t in enumerate([*items, *other, half])], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in template_match.leaks(df, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    assert set(got) == {(0, 0), (1, 1), (2, 2), (3, 3), (6, 3)}
    assert all(got[k, k]["coverage"] == 1.0 and not got[k, k]["reparameterised"] for k in range(4))


def test_short_items_leak_wherever_they_stand(spark):
    items = ["Who wrote the famous play about Hamlet", "Miles are longer than most people think", "Name 1 2 3 4 5 6"]
    before = ["", "Quiz. ", "so we ask ", "see, ", "of 12 ", "of 12. "]
    df = spark.createDataFrame([(10 * i + k, f"{b}{t} and more.") for i, t in enumerate(items) for k, b in enumerate(before)] + [(90, "of 12 miles are longer than most people think"), (91, "so we ask Maria wrote the famous play about Hamlet")], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["reparameterised"] for r in template_match.leaks(df, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    want = {(10 * i + k, i): False for i in range(3) for k in range(6)} | {(90, 1): False, (91, 0): True}
    assert got == want


def test_leaks_match_whole_passages(spark, documents, texts):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    norm = {i: " ".join(PLAIN_WORDS.findall(t.lower())) for i, t in texts.items()}
    want = {(d, i) for i, t in items.items() for d in norm if " ".join(PLAIN_WORDS.findall(t.lower())) in norm[d]}
    got = {(r["doc_id"], r["item_id"]) for r in queries()["op7_template_match"](spark, SF).collect()}
    assert got == want and want


def brute_template(text):
    """Template words, each a kind (m: name, n: number, u: unit, '': word) and a value, by a scan over plain tokens."""
    t = re.sub("[\x01\x02]", " ", text or "")
    units = set(template_match.UNITS.replace("?", "").split("|")) | {u.replace("s?", "") for u in template_match.UNITS.split("|")}
    out, last = [], None
    pattern = re.compile("(?<=[a-z0-9,;] )[A-Z][a-z]+(?![A-Za-z])|(?<![A-Za-z0-9])[0-9]+(?:[.,][0-9]+)*|[0-9A-Za-z\x80-\U0010ffff]+|[^0-9A-Za-z\x80-\U0010ffff]")
    for m in pattern.finditer(t):
        w = m.group()
        if not re.match("[0-9A-Za-z\x80-\U0010ffff]", w):
            last = (last[0], last[1] + w) if last else None
            continue
        low = w.translate(LOW)
        name = re.match("(?<=[a-z0-9,;] )[A-Z][a-z]+(?![A-Za-z])", t[m.start() :]) or (m.start() > 1 and re.fullmatch("[A-Z][a-z]+", w) and re.match("[a-z0-9,;] ", t[m.start() - 2 : m.start()]) and not re.match("[A-Za-z]", t[m.end() : m.end() + 1]))
        if name:
            out.append(("m", low))
        elif re.fullmatch("[0-9]+(?:[.,][0-9]+)*", w):
            out.append(("n", w))
        elif low in units and last is not None and out and out[-1][0] == "n" and last[1] in ("", " "):
            out.append(("u", low))
        else:
            out.append(("", low))
        last = (w, "")
    return out


def brute_leaks(docs, items, window=8):
    """Pairs with one place of the document that holds half of the item's windows with consistent slots."""
    found = {}
    for d, text in docs.items():
        dt = brute_template(text)
        kinds = [k or v for k, v in dt]
        at = defaultdict(list)
        for k in range(len(dt) - window + 1):
            at[tuple((k_, "" if k_ else v) for k_, v in dt[k : k + window])].append(k)
        for i, item in items.items():
            it = brute_template(item)
            count = len(it) - window + 1
            if count < 1:
                continue
            shifts = defaultdict(list)
            for p in range(count):
                for q in at.get(tuple((k_, "" if k_ else v) for k_, v in it[p : p + window]), ()):
                    shifts[q - p].append(p)
            for s, places in shifts.items():
                pairs = {(it[p + j], dt[s + p + j][1]) for p in places for j in range(window) if it[p + j][0]}
                if 2 * len(places) >= count and len(pairs) == len({a for a, _ in pairs}):
                    same = all(a[1] == b for a, b in pairs)
                    found[d, i] = max(found.get((d, i), (0, False)), (len(places), same))
    assert kinds is not None
    return found


def test_reparameterised_items_match_brute_force(spark, texts):
    """Items with other numbers and names written into documents, consistently and not."""
    rng = random.Random(9)
    verbs = ["sells", "counts", "carries", "paints", "repairs", "borrows", "measures", "sorts"]
    goods = ["apples", "ropes", "lamps", "boxes", "shirts", "bricks", "wheels", "maps"]
    names = ["Anna", "Peter", "Maria", "Carla", "Oscar", "Bruno", "Wendy", "Silas"]

    def item(k):
        r = random.Random(k)
        a, b, c = r.sample(names, 3)
        x, y, z = r.sample(range(10, 90), 3)
        return f"Every day {a} {r.choice(verbs)} {x} red {r.choice(goods)} while {b} {r.choice(verbs)} {y} km of road, and {c} {r.choice(verbs)} {x} blue {r.choice(goods)} so that {a} keeps {z} of the {r.choice(goods)} for {b} at home"

    def changed(text, consistent):
        values = {}
        def swap(m):
            new = values.setdefault(m.group(), str(rng.randrange(100, 999)) if m.group().isdigit() else rng.choice(["Xaver", "Yvonne", "Zora", "Quentin", "Ulla"]) + "abcdefgh"[len(values)])
            return new if consistent or rng.random() < 0.5 else "777" if m.group().isdigit() else "Nobody"
        return re.sub("(?<= )(?:[0-9]+|(?:" + "|".join(names) + "))", swap, text)

    items = {k: item(k) for k in range(12)}
    docs = dict(list(texts.items())[:40])
    base = list(docs.values())
    for n in range(150):
        k, host = rng.randrange(12), rng.choice(base)
        cut = rng.randrange(len(host) + 1)
        what = rng.choice([items[k], changed(items[k], True), changed(items[k], False), items[k][: rng.randrange(20, len(items[k]))], changed(items[k], True)[rng.randrange(60) :]])
        docs[10_000 + n] = host[:cut].rsplit(" ", 1)[0] + " " + what + " " + host[cut:].split(" ", 1)[-1]
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["n_matched"], not r["reparameterised"]) for r in template_match.leaks(df, spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()}
    want = brute_leaks(docs, items)
    assert len(want) > 80 and sum(not same for _, same in want.values()) > 20
    assert set(want) <= set(got)
    for pair, (n, same) in want.items():
        assert got[pair][0] >= n and got[pair][1] == same
    assert len(set(got) - set(want)) <= 0.03 * len(got)  # places that are only together enough


def test_rows_of_one_id_leak_by_their_own_text(spark):
    item = "a trader sells 12 red apples to Anna Holm and then sells 30 green pears to Peter for the winter market"
    docs = [(1, f"Here: {item} there."), (1, "nothing of the kind"), (None, f"It says {item}."), (None, "clean"), (2, item[:50]), (2, item[50:])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    assert {r["doc_id"] for r in template_match.leaks(df, bench).collect()} == {1, None}
    assert sorted(r["text"] for r in template_match.clean(df, bench).collect()) == sorted(["nothing of the kind", "clean", item[:50], item[50:]])


def test_items_of_one_id_and_without_id_are_looked_for_each(spark, monkeypatch):
    a = "a trader sells 12 red apples to Anna Holm and then sells 30 green pears to Peter for the winter market"
    b = "every miller grinds 7 white sacks for Carla Berg before the long night comes over 4 quiet villages again"
    changed = a.replace("12", "99").replace("Anna", "Xaver")
    docs = [(10, f"Here: {a} there."), (11, f"It says {b}."), (12, "nothing of the kind"), (13, f"Now {changed}, and {b}."), (None, f"So {a}.")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = [(1, a), (1, b), (None, a), (None, None), (3, b), (3, b)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for i, item in items:  # a twin that looks for one item at a time
        if item:
            alone = template_match.leaks(df, spark.createDataFrame([(0, item)], "item_id long, text string")).collect()
            want += [(r["doc_id"], i, r["reparameterised"]) for r in alone]
    got = [(r["doc_id"], r["item_id"], r["reparameterised"]) for r in template_match.leaks(df, bench).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {(10, 1, False), (10, None, False), (11, 3, False), (13, 1, True), (None, None, False)} <= set(got) and (10, 1, True) not in got
    only_null = spark.createDataFrame([(None, a)], "item_id long, text string")
    assert sorted(r["text"] for r in template_match.clean(df, only_null).collect()) == sorted(t for i, t in docs if i in (11, 12))


def test_large_benchmarks_are_not_broadcast(spark, monkeypatch):
    df = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "doc_id long, text string")
    bench = df.withColumnRenamed("doc_id", "item_id")
    want = template_match.leaks(df, bench).collect()
    monkeypatch.setattr(template_match, "BROADCAST_WINDOWS", 0)
    assert template_match.leaks(df, bench).collect() == want and len(want) == 1


# 8


def test_media_round_trip(spark, documents, texts):
    for r in queries()["op8_media_sequences"](spark, SF).collect():
        raw = texts[r["doc_id"]].encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        stored = media.to_png(payload)
        assert media.from_png(stored) == payload and (r["media_bytes"], r["media_sha256"]) == (len(stored), hashlib.sha256(stored).hexdigest())
        grid = [payload[k : k + 64] for k in range(0, len(payload), 64)]
        steps = sum(abs(a - b) for line in grid for a, b in zip(line, line[1:], strict=False))
        bins = [sum(64 * k <= x < 64 * k + 64 for x in payload) for k in range(4)]
        assert r["feature"] == f"{len(grid)}x64:{sum(payload)}:{steps}:{len(set(payload))}:{'/'.join(map(str, bins))}"
        # the sequence: lines that are not blank are its text blocks, the medium stands after the middle line
        lines = texts[r["doc_id"]].split("\n")
        half = math.ceil(len(lines) / 2)
        blocks = [bool(re.sub(r"\s+", " ", x).strip()) for x in lines]
        assert (r["media_pos"], r["n_items"]) == (sum(blocks[:half]), sum(blocks) + 1)
        assert (r["caption"] or "") == re.sub(r"\s+", " ", lines[half - 1][: media.CAPTION]).strip()
    with pytest.raises(ValueError, match="damaged"):
        media.from_png(stored[:45] + bytes([stored[45] ^ 1]) + stored[46:])


def test_sequences_keep_order_captions_and_unknown_media(spark):
    html = '<p>One &amp; two</p><script>var x="<p>";</script><figure><img src="sha256:aa" alt="alt"><figcaption>The cap</figcaption></figure>tail<img src="sha256:bb"><img src="sha256:aa">'
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<p>only text")], "page_id long, html string")
    store = spark.createDataFrame([("aa", 7)], "digest string, size int")
    got = {r["page_id"]: r["items"] for r in media.resolve(media.parse_sequences(pages, "page_id", "html"), store, "page_id").collect()}
    assert [(x["kind"], x["text"] or x["ref"], x["caption"], x["media"] and x["media"]["size"]) for x in got[1]] == [("text", "One & two", None, None), ("media", "sha256:aa", "The cap", 7), ("text", "tail", None, None), ("media", "sha256:bb", None, None), ("media", "sha256:aa", None, 7)]
    assert got[2] == [] and [x["text"] for x in got[3]] == ["only text"]


def test_several_media_of_a_page_keep_their_places(spark):
    """Real pages with media put between their paragraphs, against a list that says what goes where."""
    rng = random.Random(6)
    pages, payloads, want = [], [], {}
    for r in spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").limit(20).collect():
        parts, expected = re.findall(r"<p>([^<]{5,200})", r["html"])[:8], []
        html = ""
        for k, part in enumerate(parts):
            html += f"<p>{part}</p>"
            expected.append(("text", None, None))
            if rng.random() < 0.6:
                payload = f"medium {rng.randrange(12)}"  # many pages share one
                digest = hashlib.sha256(media.pad(payload.encode())).hexdigest()
                payloads.append((payload,))
                html += f'<figure><img src="sha256:{digest}"><figcaption>cap {k}</figcaption></figure>'
                expected.append(("media", f"cap {k}", digest))
        pages += [(r["page_id"] % 7, html)]  # ids repeat
        want.setdefault(r["page_id"] % 7, []).append(expected)
    store = media.media_features(media.store_media(spark.createDataFrame(payloads, "text string"), "text"))
    assert store.count() == len({p for (p,) in payloads})
    sequences = media.parse_sequences(spark.createDataFrame(pages, "page_id long, html string"), "page_id", "html")
    got = {}
    for r in media.resolve(sequences, store, "page_id").collect():
        assert [x["pos"] for x in r["items"]] == list(range(len(r["items"])))
        got.setdefault(r["page_id"], []).append([(x["kind"], x["caption"], x["media"] and x["media"]["payload_sha256"]) for x in r["items"]])
    key = lambda rows: sorted(map(str, rows))
    assert {i: key(x) for i, x in got.items()} == {i: key(x) for i, x in want.items()}


def test_a_caption_outside_a_figure_is_no_medium_s():
    items = media.sequence('<img src="a"><figcaption>lost</figcaption><figure><img src="b"><figcaption>kept</figcaption></figure>')
    assert [(x["ref"], x["caption"]) for x in items] == [("a", None), ("b", "kept")]


def test_real_pages_parse(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = media.parse_sequences(pages, "page_id", "html").collect()
    assert len(got) == pages.count() and all([x["pos"] for x in r["items"]] == list(range(len(r["items"]))) for r in got)


# 9


def test_pieces_match_the_library(texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECE_BPE))
    table = piece_merge.piece_table(vocabulary(PIECE_BPE))
    rows = [*list(texts.values())[:80], *odd_texts(6, 1500, list(" \n\tabcdehlt▁éß中文字日本語\U0001f642\x00​.,!0123") + ["<s>", "<0x41>", "  "]), "a" * 3000, " " * 257, "中文字" * 300, ""]
    want = sp.encode(rows, num_threads=1)
    ids, at = table.encode(rows)
    raw, ends = table.decode(ids, at)
    for k in range(len(rows)):
        assert ids[at[k] : at[k + 1]].tolist() == want[k]
        assert raw[ends[k] : ends[k + 1]].tobytes().decode() == sp.decode(want[k])


def test_piece_digests(spark, documents, texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECE_BPE))
    for r in queries()["op9_piece_merge"](spark, SF).collect():
        ids = sp.encode(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest())


# 10


def brute_components(texts, n_words, num, den):
    sets = {}
    for i, t in texts.items():
        w = words(t)
        sets[i] = {tuple(w[k : k + n_words]) for k in range(len(w) - n_words + 1)} if len(w) >= n_words else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets, key=lambda i: len(sets[i]))
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            a, b = sets[i], sets[j]
            if len(a) * den < len(b) * num:
                break
            if a and len(a & b) * den >= len(a | b) * num:
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize(("n_words", "num", "den"), [(3, 9, 10), (5, 4, 5)])
def test_components_match_all_pairs(spark, texts, n_words, num, den, monkeypatch):
    rng = random.Random(7)
    rows = {}
    for g in range(12):  # groups of near copies around a text, and chains that drift away
        base = [f"g{g}w{rng.randrange(200)}" for _ in range(rng.choice([8, 12, 40, 150]))]
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randrange(1 + len(base) // 12)):
                copy[rng.randrange(len(copy))] = f"n{rng.randrange(10**6)}"
            rows[len(rows)] = " ".join(copy)
            if g % 3 == 0:
                base = copy
    passage = " ".join(f"p{k}" for k in range(30))
    for _ in range(40):
        rows[len(rows)] = passage + " " + " ".join(f"q{rng.randrange(50)}" for _ in range(rng.randrange(8)))
    rows |= {1000 + i: t for i, t in list(texts.items())[:60]}
    for _ in range(2):  # a group whose copies are linked by a chain from block to block, and one that is not linked at all
        common = " ".join(f"r{rng.randrange(10**6)}" for _ in range(12))
        for k in range(40):
            rows[len(rows)] = common + " " + " ".join(f"t{k // 2}x{j}" for j in range(14))
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "LARGE", 100)
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(5)
    measure = jaccard_join.Measure(n_words, num, den)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.link_components(df, measure=measure).collect()}
    assert got == brute_components(rows, n_words, num, den)


def test_boundary_follows_the_cost():
    m = jaccard_join.Measure()
    assert jaccard_join.boundary({}, m) == 0
    assert 9 <= jaccard_join.boundary({10: 1000, 20: 500, 500: 10}, m) < 500
    assert jaccard_join.boundary({5000: 10}, m) == 0


@pytest.mark.parametrize("few", [0, 1 << 20])
def test_components_of_chains_and_stars(spark, monkeypatch, few):
    monkeypatch.setattr(jaccard_join, "FEW_LINKS", few)
    links = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = {r["id"]: r["label"] for r in jaccard_join.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1, 41), 1), **dict.fromkeys(range(100, 140), 100)}


# pipeline


def test_run_matches_a_brute_force_pipeline(spark, documents):
    """run() against five plain stages, each on what the one before it kept."""
    import sentencepiece
    from pyspark.sql import functions as F

    import corpus_pipeline

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    rows = [(r["doc_id"], r["text"], r["source"]) for r in documents.collect()]
    # 1: quality
    known = {r["__id"]: (r["__class"], r["__half"]) for r in importance.labelled_rows(labels).collect()}
    noise = {r[0]: r[1] for r in documents.select("doc_id", importance.gumbel(F.col("doc_id"))).collect()}
    kept = brute_importance([r[:2] for r in rows], known, noise)[1]
    rows = [r for r in rows if r[0] in kept]
    # 2: lines
    sites, first = defaultdict(set), {}
    for i, t, s in sorted(rows):
        for k, line in enumerate((t or "").split("\n")):
            sites[line].add(s)
            first.setdefault(line, (i, k))
    cut = []
    for i, t, s in rows:
        lines = (t or "").split("\n")
        left = [line for k, line in enumerate(lines) if line == "" or len(sites[line]) < line_spread.MIN_SITES or first[line] == (i, k)]
        if len(left) == len(lines) or "\n".join(left).strip(" "):
            cut.append((i, t if len(left) == len(lines) else "\n".join(left), s))
    # 3: near duplicates
    groups = brute_components({i: t or "" for i, t, _ in cut}, 5, 4, 5)
    rows = [r for r in cut if groups[r[0]][1] == r[0]]
    # 4: decontamination
    plain = {i: " ".join(PLAIN_WORDS.findall(t.lower())) for i, t in items.items()}
    leaking = {d for d, _ in brute_leaks({r[0]: r[1] for r in rows}, items)}
    leaking |= {r[0] for r in rows if any(p in " ".join(PLAIN_WORDS.findall((r[1] or "").lower())) for p in plain.values())}
    rows = [r for r in rows if r[0] not in leaking]
    # 5: pieces
    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECE_BPE))
    want = {}
    for i, t, _ in rows:
        ids = sp.encode(t or "")
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and 50 < len(got) < documents.count()


def test_stages_keep_the_columns_of_documents(spark, documents):
    import corpus_pipeline

    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.schema == documents.schema
