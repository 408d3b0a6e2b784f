"""Operators against plain versions, on small tables with nulls, empty and long texts, ties, repeats and extra columns."""

import hashlib
import html as entities
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF
from helpers import same
from pyspark.sql import functions as F

from tintloom.llm import chat, decontaminate, html_text, jaccard, lm_score, mix, pfor, quality, queries, repeats, url_filter
from tintloom.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD, ALNUM = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ODD = [None, "", " \n\t", "one", "One two", "a b c d e", "é É x y", "<|endoftext|> İ? ΑΣ. don't", "x" * 30_000, "w " * 20_000]


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({"source": F.lit("s"), "n_words": F.lit(1), "spans": F.lit("x")}).repartition(3)


def sample(n=120, seed=1):
    """Edited copies of a base, documents around a common passage, and odd texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    base, passage, texts = [rng.choice(words) for _ in range(100)], [rng.choice(words) for _ in range(40)], list(ODD)
    for _ in range(n):
        w = list(base)
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            w[rng.randrange(len(w))] = rng.choice(words)
        texts.append(" ".join(w))
        texts.append(" ".join([rng.choice(words) for _ in range(rng.randrange(50))] + passage))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_statement(name, spark, duck):
    same(queries.queries()[name], queries.oracle_sql()[name], spark, duck, SF)


def test_all_ten_are_registered():
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{i}" for i in range(1, 11)]


def test_url_filter(spark):
    urls = ["http://A.ORG/x", "http://sub.example.org/es/1", "http://example.org/en/12", "http://notexample.org/es/", "http://x.com/de/1?utm=1", "http://x.com/it", "http://x.com", "x", None, "", "http://l.net/p#f", "http://l.net/p", "http://comx/fr/", "HTTP://b.com/FR/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))
    listed = spark.createDataFrame([("l.net/p",), ("l.net/p",), (None,)], "canonical string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, queries.URL_RULES, listed).collect()}
    assert found[0] == ("a.org", "/x", "org/", "allow") and found[1] == ("sub.example.org", "/es/1", "example.org/es/", "block")
    assert found[2][2:] == ("example.org/en/1", "block") and found[3][2:] == ("org/", "allow") and found[4][2:] == ("com/de/", "block")
    assert [found[i][2:] for i in (5, 6, 7, 8, 9, 12, 13)] == [(None, "allow")] * 7 and found[8][:2] == ("", "")
    assert found[10] == found[11] == ("l.net", "/p", None, "block")
    assert url_filter.filter_urls(pages.limit(0), queries.URL_RULES, listed.limit(0)).count() == 0


@pytest.mark.parametrize("most", [url_filter.MAX_RULES, 3])
def test_url_rules_of_any_number(spark, monkeypatch, most):
    monkeypatch.setattr(url_filter, "MAX_RULES", most)
    rng = random.Random(2)
    hosts = ["", "com", "a.com", "b.a.com", "x.org", "org", "a..com", "com."]
    rules = [url_filter.Rule(rng.choice(["allow", "block"]), rng.choice(hosts), rng.choice(["/", "/a", "/ab", "/abc/", "", "/é"])) for _ in range(60)]
    urls = [f"https://{rng.choice(hosts)}{rng.choice(['/', '/a', '/abc/d', '', '/é?q', '/' + 'a' * 9000])}" for _ in range(80)] + [None, "x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns({c: F.lit("mine") for c in ("__canonical", "__listed", "canonical", "__host", "rule")})
    rows = url_filter.filter_urls(pages, rules, spark.createDataFrame([], "canonical string")).collect()
    assert len(rows) == len(urls) and all(r["__canonical"] == r["__listed"] == r["canonical"] == r["__host"] == "mine" for r in rows)
    for r in rows:
        fits = [(len(x.host + x.path), i, x) for i, x in enumerate(rules) if (r.host == x.host or r.host.endswith("." + x.host)) and r.path.startswith(x.path)]
        best = max(fits)[2] if fits else None
        assert (r.rule, r.verdict) == ((best.host + best.path, best.verdict) if best else (None, "allow"))


def test_bloom_filter_passes_every_listed_url(spark):
    listed = spark.range(5000).select(F.concat(F.lit("h/"), F.col("id")).alias("canonical"))
    others = spark.range(5000, 10000).select(F.concat(F.lit("h/"), F.col("id")).alias("canonical"))
    assert url_filter.listed_urls(listed.union(others).union(listed), listed).count() == 5000


def test_chat(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (3, 1, "assistant", "yo"), (4, 0, "user", None), (4, 5, None, "<|im_end|>"), (5, 0, "user", "yo"), (None, 0, "user", "lost")]
    found = {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("k", F.lit(1))).collect()}
    assert set(found) == {1, 4, 5} and found[1].n_equal == 2 and found[1].text == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n"
    assert found[4].text == "<|im_start|>user\n<|im_end|>\n<|im_start|>\n< |im_end|><|im_end|>\n"
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_mix(spark):
    rows = [(i, s, "w " * n) for i, (s, n) in enumerate([("a", 5)] * 400 + [("b", 5)] * 400 + [(None, 2)] * 300 + [("é", 0)] * 3)] + [(None, "b", None), (7, "a", "w " * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("__copies", F.lit("mine"))
    plan = mix.plan_mix(docs.drop("__copies"))
    targets = {r["source"]: (r["__source_size"], r["__target"]) for r in plan.select("source", "__source_size", "__target").distinct().collect()}
    total = 2005 + 2000 + 600
    assert targets["é"] == (0, 0.0) and targets[None] == (600, 1200.0)
    rest = 1.5 * total - 1200
    assert targets["a"] == (2005, min(4010.0, rest * 3 / 4)) and sum(t for _, t in targets.values()) == pytest.approx(1.5 * total)
    taken = {r["source"]: r["n"] for r in plan.groupBy("source").agg(F.sum(F.col("__copies") * F.col("__size")).alias("n")).collect()}
    assert taken["a"] == pytest.approx(targets["a"][1], rel=0.1) and plan.agg(F.max("__copies")).first()[0] <= 2
    mixed = mix.mix(docs)
    assert mixed.columns == docs.columns and mixed.where("`__copies` <> 'mine'").count() == 0
    assert mixed.count() == plan.agg(F.sum("__copies")).first()[0] == mix.mix(docs.repartition(7)).count()
    assert mix.mix(docs.limit(0)).count() == 0
    nobody = spark.createDataFrame([(i % 2 or None, "s" if i < 800 else "t", f"{i} w") for i in range(1000)], "doc_id long, source string, text string")
    plan = mix.plan_mix(nobody)
    for r in plan.groupBy("source").agg(F.sum(F.col("__copies") * F.col("__size")).alias("n"), F.first("__target").alias("t")).collect():
        assert r["n"] == pytest.approx(r["t"], rel=0.1)


def _shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def _components(rows):
    sets = [_shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    index = defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in index[g])
        for g in s:
            index[g].append(i)
        for j, o in common.items():
            if 100 * o >= 80 * (len(s) + len(sets[j]) - o):
                root[find(i)] = find(j)
    least = defaultdict(lambda: 1 << 60)
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least[find(i)], d)
    return {d: (len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)}


def family(n=160, seed=5):
    """Copies of one text at all distances around the threshold, with copies of those: sets that a pivot leaves open."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(150)]
    far = []
    for _ in range(12):
        w = list(base)
        for k in rng.sample(range(150), rng.choice([3, 5, 7, 9])):
            w[k] = f"e{rng.randrange(400)}"
        far.append(w)
    texts = [" ".join(base)] * 2
    for _ in range(n):
        w = list(rng.choice([base, *far, *far]))
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            w[rng.randrange(len(w))] = f"f{rng.randrange(10**6)}"
        if rng.random() < 0.2:
            del w[rng.randrange(100) :][: rng.randrange(30)]
        texts.append(" ".join(w))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("limits", [{}, {"LIGHT": 3, "BLOCK": 2, "BALL": 10, "COLUMNS": 7, "CHUNK": 500}, {"LIGHT": 2, "HEAVY_MOST": 50, "HOT": 3}])
@pytest.mark.parametrize("rows", [sample(), family()])
def test_jaccard(spark, monkeypatch, limits, rows):
    if "LIGHT" in limits:
        monkeypatch.setattr(jaccard.heavy_keys, "__defaults__", (limits["LIGHT"],))
    for name, value in limits.items():
        monkeypatch.setattr(jaccard, name, value)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs_of(spark, rows)).collect()}
    assert found == _components(rows)


def test_jaccard_counts_heavy_elements_over_all_rows(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 50)
    rows = sample()
    counts = Counter(e for _, t in rows for e in jaccard.shingle_sets([(t or "").encode()])[0].tolist())
    for most, light in ((2_000_000, 16), (10, 32)):
        monkeypatch.setattr(jaccard, "HEAVY_MOST", most)
        keys, mask = jaccard.heavy_keys(docs_of(spark, rows))
        while sum(n > light for n in counts.values()) > most:
            light *= 2
        assert sorted(e & mask for e, n in counts.items() if n > light) == keys.tolist()


def test_jaccard_list_pairs_are_those_of_fitting_sizes_and_positions():
    rng = random.Random(3)
    rows = sorted((rng.randrange(60), n := rng.randrange(20, 60), rng.randrange(min(n // 5 + 1, 12)), k) for k in range(600))
    element, n, pos, node = np.array(rows, np.int64).T
    found = np.concatenate([*jaccard.list_pairs(element, node, n, np.zeros_like(n), pos), np.empty((3, 0), np.int64)], axis=1)
    want = set()
    for e, a, x, i in rows:
        for f, b, y, j in rows:
            if e == f and i < j and 5 * min(a, b) >= 4 * max(a, b) and 9 * (min(x, y) + 1 + min(a - x, b - y) - 1) >= 4 * (a + b):
                want.add((i, j))
    assert len(want) > 100 and sorted(zip(*found[:2].tolist(), strict=True)) == sorted(want)


def test_jaccard_forest_connects_what_the_matrix_connects():
    hit = np.random.default_rng(1).random((30, 40)) < 0.04
    parts = []
    for pairs in (zip(*np.nonzero(hit), strict=True), jaccard.forest(hit)):
        label = list(range(70))
        for r, c in pairs:
            x, y = label[r], label[30 + c]
            label = [x if v == y else v for v in label]
        parts.append([label.index(v) for v in label])
    assert parts[0] == parts[1]
    assert len(jaccard.forest(np.ones((30, 40), bool))) == 69


def test_jaccard_of_odd_tables(spark):
    docs = docs_of(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "other words"), (3, "A b c d e f")])
    found = Counter((r.doc_id, r.component_id) for r in jaccard.near_duplicates(docs).collect())
    assert found == {(1, 1): 2, (None, 1): 1, (None, None): 1, (3, 1): 1}
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0


def test_jaccard_of_documents_with_several_texts(spark, monkeypatch):
    monkeypatch.setattr(jaccard.heavy_keys, "__defaults__", (2,))
    rows = [(i % 100, t) for i, t in family()]
    names = dict(enumerate(rows))
    parts = _components([(i, t) for i, (_, t) in names.items()])
    label = {i: c for i, (_, c) in parts.items()}
    for i, (d, t) in names.items():
        j = next(k for k, (e, _) in names.items() if e == d)
        label = {k: label[j] if v == label[i] else v for k, v in label.items()}
    least = {c: min(names[i][0] for i in label if label[i] == c) for c in set(label.values())}
    found = {(r.doc_id, r.component_id) for r in jaccard.near_duplicates(docs_of(spark, rows)).collect()}
    assert found == {(names[i][0], least[c]) for i, c in label.items()}


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 50), (60, 100), (60, 60), (200, 201), (200, 201)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 1 for i in range(1, 41)}, 50: 50, 100: 50, 60: 50, 200: 200, 201: 200}


@pytest.mark.parametrize("block_chars", [decontaminate.BLOCK_CHARS, 200])
def test_decontamination(spark, block_chars):
    rows = sample(30)
    items = [(1, rows[11][1] or "q"), (2, "w1 w2"), (3, None), (4, "!!"), (5, " ".join(f"w{i}" for i in range(30))), (10, "w1 w2")]
    windows = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall((text or "").translate(LOWER))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(str(item))
    want = {}
    for doc, text in rows:
        w, hit, ids = ALNUM.findall((text or "").translate(LOWER)), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    ids |= windows[tuple(w[k : k + n])]
        want[doc] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit))
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(spark, rows)
    found = decontaminate.decontaminate(docs, bench, block_chars=block_chars)
    assert {r[0]: tuple(r)[1:] for r in decontaminate.digest(found).collect()} == want and any(v[4] for v in want.values())
    for r in found.where(F.size("__runs") > 0).select("text", "__runs").limit(20).collect():
        for run in r["__runs"]:
            assert len(ALNUM.findall(r["text"][run["start"] : run["stop"]].translate(LOWER))) == run["last"] - run["first"] + 1
    assert decontaminate.decontaminate(docs, bench.limit(0)).where(F.size("__runs") > 0).count() == 0
    assert decontaminate.decontaminate(docs.limit(0), bench).count() == 0


def _repeats(rows, length=100):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        raw = (text or "").encode()
        cover = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if raw[i : i + length] in seen:
                cover[i : i + length] = b"\1" * length
            seen.add(raw[i : i + length])
        kept = bytes(b for b, c in zip(raw, cover, strict=True) if not c)
        out[doc] = (len(raw), sum(cover), sum(c and not cover[i - 1] if i else c for i, c in enumerate(cover)), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("many", [repeats.MANY_CONTEXTS, 3])
def test_repeats(spark, monkeypatch, many):
    monkeypatch.setattr(repeats, "MANY_CONTEXTS", many)
    monkeypatch.setattr(repeats, "SORT_BYTES", 5000)
    rng = random.Random(3)
    base = "".join(rng.choice("ab cé") for _ in range(500))
    texts = ["a" * 350, "ab" * 150, "a" * 99, "a" * 100, None, "", base * 2, base[100:300] * 3]
    for _ in range(25):
        t = list(base)
        for _ in range(rng.choice([0, 1, 3])):
            t[rng.randrange(len(t))] = "x"
        texts.append("".join(t)[rng.randrange(100) :])
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert {r[0]: tuple(r)[1:5] for r in repeats.remove_repeats(docs_of(spark, rows)).collect()} == _repeats(rows)


def test_repeats_of_odd_tables(spark):
    text = "".join(random.Random(9).choices("abcdefgh", k=150))
    found = repeats.remove_repeats(docs_of(spark, [(2, text), (2, text), (None, text), (None, None)]), keep=True).collect()
    assert sorted((r.doc_id or -1, r.n_removed, len(r.kept)) for r in found) == [(-1, 0, 0), (-1, 0, 150), (2, 150, 0), (2, 150, 0)]
    assert repeats.remove_repeats(docs_of(spark, []).limit(0)).count() == 0


@pytest.mark.parametrize("many", [repeats.MANY_CONTEXTS, 0])
def test_repeats_of_many_rows_with_one_id(spark, monkeypatch, many):
    monkeypatch.setattr(repeats, "MANY_CONTEXTS", many)
    rng = random.Random(8)
    a, b, c = ("".join(rng.choices("abcdefgh", k=150)) for _ in range(3))
    rows = [(5, 0, a), (5, 1 << 19, a), (5, 1 << 20, "x" + b), (5, (1 << 20) + 1, "y" + b + c), (5, 1 << 40, a + "z" + c)]
    gone = {}
    for part in repeats.repeated_parts(spark.createDataFrame(rows, "doc_id long, part long, text string"), repeats.LENGTH, repeats.GRAMS):
        for r in part.collect():
            gone.setdefault((r.doc_id, r.part), []).append((r.start, r.stop))
    assert {k: repeats.merged_spans(v) for k, v in gone.items()} == {(5, 1 << 19): [(0, 150)], (5, (1 << 20) + 1): [(1, 151)], (5, 1 << 40): [(0, 150), (151, 301)]}


def test_maximal_repeats_give_all_occurrences():
    words = [b"xxABCDEFGHIJ1", b"yyABCDEFGHIJ2", b"zABCDEFGHIJK"]
    numbers = np.array([len(w) - 7 for w in words])
    groups = {(n, tuple(zip(who.tolist(), where.tolist(), strict=True))) for n, who, where in repeats.maximal_repeats(words, numbers, np.array([0, 1, 2]), 8)}
    assert groups == {(10, ((0, 2), (1, 2), (2, 1)))}


def _base_counts(text):
    text = text or ""
    w = WORD.findall(text)
    triples = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if triples[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_verdicts(spark):
    rows = sample(20) + [(1000, "a b c\na b c\n\n a b c\n#*$%&|<>"), (1001, None)]
    docs = docs_of(spark, rows)
    found = {r.doc_id: r for r in quality.judge(docs, quality.NEUTRAL).collect()}
    for doc, text in rows:
        r, want = found[doc], _base_counts(text)
        assert (r["__n_words"], r["__word_chars"], r["__n_symbols"], r["__n_dup_lines"], r["__n_repeat_words"]) == want
        assert r["__base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and r["__kept"] == (not r["__base_failed"])
    assert quality.judge(docs.limit(0), quality.NEUTRAL).count() == 0
    assert quality.fit_on(docs, spark.createDataFrame([(1, 1), (1, 0), (None, 1)], "doc_id long, quality int")).shift == quality.NEUTRAL.shift


def test_quality_accuracy_on_held_out_labels(spark):
    folder = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.fit_on(docs, labels.where("doc_id % 3 > 0"))
    judged = quality.judge(docs, model, ["doc_id"]).join(labels.where("doc_id % 3 = 0"), "doc_id").where("not __base_failed")
    right = judged.agg(F.avg((F.col("__kept") == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert right > 0.97


def test_language_model(spark):
    rng = random.Random(2)
    text = lambda: " ".join(f"{w} {w}b {w}c" for w in (rng.choice("abcdefgh") for _ in range(60)))
    rows = [(i, text()) for i in range(150)] + [(900, " ".join(rng.sample(text().split(), 180))), (901, None), (902, "")]
    docs = docs_of(spark, rows)
    vocabulary, net = lm_score.train(docs)
    found = {r.doc_id: r for r in lm_score.score(docs, vocabulary, net).collect()}
    assert found[900].mean_log_likelihood < min(found[i].mean_log_likelihood for i in range(150))
    assert found[901].n_words == found[902].n_words == 0 and found[901].mean_log_likelihood is None and found[902].log_likelihood == 0
    reader = lm_score.Reader(vocabulary)
    ids, context, first = reader([(rows[0][1] or "").encode()])
    assert found[0].log_likelihood == pytest.approx(lm_score.log_probabilities(net, ids, context).sum(), abs=0.02)
    assert lm_score.score(docs.limit(0), *lm_score.train(docs.limit(0))).count() == 0


def test_language_model_learns_from_every_position(spark):
    text = " ".join(f"w{i}" for i in range(16))
    vocabulary, net = lm_score.train(docs_of(spark, [(i, text) for i in range(3000)]))
    ids, context, _ = lm_score.Reader(vocabulary)([text.encode()])
    assert lm_score.log_probabilities(net, ids, context).min() > -3


@pytest.mark.parametrize("common", [lm_score.COMMON, 100])
def test_language_model_tells_words_of_a_bucket_apart(spark, monkeypatch, common):
    monkeypatch.setattr(lm_score, "COMMON", common)
    rng = random.Random(3)
    texts = [" ".join([f"w{int(rng.paretovariate(0.5)) % 9999}" for _ in range(200)] + ["everywhere"] * (i < 3)) for i in range(150)]
    counts = Counter(w for t in texts for w in t.split())
    docs = docs_of(spark, [*enumerate(texts), (None, texts[0]), (None, "unseen w1")])
    vocabulary, net = lm_score.train(docs.where(F.col("doc_id").isNotNull()))
    reader, words = lm_score.Reader(vocabulary), [*counts, "unseen"]
    ids = reader([" ".join(words).encode()])[0].tolist()
    number, buckets = dict(zip(words, ids, strict=True)), Counter()
    for w, n in counts.items():
        buckets[number[w]] += n
    assert len(vocabulary.listed) == 960 and counts["everywhere"] == 3
    assert sorted((counts[w] for w in words if number[w] < 960), reverse=True) == sorted(counts.values(), reverse=True)[:960]
    found = Counter((r.doc_id, r.n_words, r.log_likelihood) for r in lm_score.score(docs, vocabulary, net).collect())
    assert sum(found.values()) == 152
    for doc, text in [*enumerate(texts), (None, texts[0]), (None, "unseen w1")]:
        ids, context, _ = reader([text.encode()])
        want = lm_score.log_probabilities(net, ids, context).sum()
        want += sum(np.log((counts[w] or 0.5) / (buckets[number[w]] + 0.5)) for w in text.split() if number[w] >= 960)
        assert any(d == doc and n == len(text.split()) and got == pytest.approx(want, abs=0.03) for d, n, got in found)


def test_language_model_depends_on_the_rows_alone(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "SHARD_WORDS", 400)  # some ninety shards: averages of averages
    monkeypatch.setattr(lm_score, "COPIES", 7)
    rows = [*sample(), *[(None, "a text that many rows without an id repeat")] * 150, *[(7, "equal rows")] * 20]
    docs = docs_of(spark, rows)
    dealt = lm_score.spread_copies(lm_score.sequences(docs, lm_score.vocabulary_of(docs)))
    assert dealt.count() == sum(1 for _, t in rows if t and WORD.search(t)) and dealt.groupBy("spread").count().agg(F.max("count")).first()[0] < 4
    nets = []
    for count in (1, 5, 13):
        monkeypatch.setattr(lm_score, "PARTITIONS", {1: 3, 5: 1 << 16, 13: 10}[count])
        random.Random(count).shuffle(rows)
        vocabulary, net = lm_score.train(spark.createDataFrame(rows, "doc_id long, text string").repartition(count))
        nets.append((vocabulary.listed, *net))
    assert all((a == b).all() for other in nets[1:] for a, b in zip(nets[0], other, strict=True))
    assert not (nets[0][1] == lm_score.new_network().embed).all()


def test_network_gradients():
    rng = np.random.default_rng(1)
    net = lm_score.Network(*[p.astype(np.float64) for p in lm_score.new_network()])
    ids, context = rng.integers(0, lm_score.VOCABULARY, 40), rng.integers(0, lm_score.VOCABULARY + 1, (4, 40))
    for p, g in zip(net, lm_score.gradients(net, ids, context), strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, values = p[at], []
        for step in (1e-5, -1e-5):
            p[at] = old + step
            values.append(-lm_score.log_probabilities(net, ids, context).mean())
        p[at] = old
        assert (values[0] - values[1]) / 2e-5 == pytest.approx(g[at], rel=1e-4)


def test_token_files(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    rng = random.Random(4)
    odd = ["".join(rng.choice("aZz9 .,'!?\n ́İΣéß<|>…中한ŉⅫ½-") for _ in range(rng.randrange(40))) for _ in range(300)]
    rows = [(i * 3 % 1009, t) for i, t in enumerate(odd)] + sample(10)[:15] + [(None, "null id"), (5, "b"), (5, "a")]
    start, want = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, pfor.END_ID]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = [tuple(r) for r in pfor.tokens_round_trip(docs_of(spark, rows), queries.tokenizer_path()).collect()]
    assert sorted(found, key=lambda r: r[1]) == want
    assert pfor.tokens_round_trip(docs_of(spark, rows).limit(0), queries.tokenizer_path()).count() == 0


@pytest.mark.parametrize("high", [1, 2, 1000, 65_536, 2**32 - 1])
def test_blocks_round_trip(high):
    rng = np.random.default_rng(high)
    ids = rng.integers(0, high, 3000, dtype=np.uint32)
    ids[::97] = 2**32 - 1
    blocks = pfor.encode_blocks(ids)
    starts = np.cumsum([0, *map(len, blocks)])[:-1]
    assert (pfor.decode_blocks(b"".join(blocks), starts)[: len(ids)] == ids).all()
    assert (pfor.decode_blocks(blocks[1], np.array([0])) == ids[1024:2048]).all()


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body class="x-1"><header>menu</header><nav><a href=/>no</a></nav><div class="cookie-notice">no</div>
<div id=main><div class="post-{n} entry"><h1>Big &amp; bold</h1><p>First <b>para</b>graph one<br>line &eacute;&#x41;. It is long enough to win the vote here.<p>Second, with a <a href=x>link</a>.<script>var a = "</p>no";</script>
<!-- no --><ul><li>one<li>two</ul><form>no</form><div class="ad">no</div></div><div class="comments"><p>no, a reader comment that goes on for quite a while, longer than others</p></div></div><aside>no</aside><footer>no</footer></body></html>"""
TEXT = "Big & bold First paragraph one line éA. It is long enough to win the vote here. Second, with a link. one two"


def test_html(spark):
    rows = [(i, f"http://a.example/{i}", PAGE.replace("{n}", str(i))) for i in range(5)]
    rows += [(10, "http://b.example/", "<p>alone"), (11, None, None), (12, "http://b.example/", ""), (13, "x", "<nav>no</nav>"), (14, "http://a.example/odd", "<article>Other <i>place</i> for text</article>"), (15, "http://c.example", "a < b & c <unclosed 'x"), (15, "http://c.example", "a < b & c <unclosed 'x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    found = {r.page_id: r.text for r in html_text.extract_pages(pages).collect()}
    assert [found[i] for i in range(5)] == [TEXT] * 5
    assert (found[10], found[11], found[12], found[13], found[14]) == ("alone", "", "", "", "Other place for text")
    assert html_text.extract_pages(pages).count() == len(rows) and html_text.extract_pages(pages.limit(0)).count() == 0


def test_html_attributes():
    page = """<body><article><h1>Head</h1><p title="a hidden gem">One <a href="/hidden-valley">two</a></p><p data-hidden="false" data-role=banner>Three <a href="/x?id=related">four</a></p>
<p data-x='class="ad"'>five</p><p/title=x hidden>no</p><p CLASS = 'ad'>no</p><p class=x class=ad>six</p><p title="a"role="banner">no</p><p aria-hidden=true>no</p><p style="display: none">no</p></article></body>"""
    assert html_text.extract(page, None) == "Head One two Three four five six"


def test_html_keeps_what_only_sounds_like_furniture():
    page = """<article><p class="social-history">one</p><div class="article-header">two</div><fieldset>three</fieldset><p>a &am<b>p;</b> b</p><p class="shared-memory">x &amp<i>; y</i></p>
<div class="share-buttons">no</div><div id="postComments">no</div><div class="x related-posts">no</div><div class="cookie-notice">no</div><p class="header">four</p></article>"""
    assert html_text.extract(page, None) == "one two three a &amp; b x &; y four"


def test_html_without_article_or_main():
    words, head = "some text " * 40, "<h1>Head</h1>"
    whole = f"Head {words.strip()}"
    inner = f"<div class=title>{head}</div><div class=body><p>{words}</p></div>"
    assert html_text.extract(f"<body>{inner}</body>", None) == whole
    assert html_text.extract(f"<body><div class=wrap>{inner}<div class=sidebar>no</div></div><div class=legal>rights {'x ' * 20}</div></body>", None) == whole
    assert html_text.extract(f"<body><div class=wrap>{inner}</div><div><a href=x>{'other pages ' * 9}</a></div></body>", None) == whole


@pytest.mark.parametrize("part", ["<div>x", "<b>x", "<article>x", "<main><p>x", "<li><b>x", "<b></i>x", "<table><tr><td>x", "<p title='", "<!--", "<script>"])
def test_html_of_very_deep_pages(part):
    page = part * 20_000
    assert html_text.extract(page, html_text.vote(page)).count("x") == page.count("x")


def test_html_beside_the_best_container(spark):
    h, p, more = "<h1>A headline of some words</h1>", "<p>The lead.</p>", "words that go on and on " * 40
    bodies = {
        "a": f"<div><article>{h}{p}<div class=body>{more}</div><p>End.</p></article></div>",
        "b": f"<article>{h}<section>{more}</section>{p}<section>short</section></article><div>other</div>",
        "c": f"<main>{h}{p}<div class=body>{more}</div></main><div>other</div>",
        "d": f"<main>{h}<article>{p}<div class=body>{more}</div></article></main>",
        "e": f"<main><article>{h}{p}<div class=body>{more}</div></article><div><a href=x>Another page of this host</a></div></main>",
        "f": f"<main><h1>News</h1><article>{h}{p}<div class=body>{more}</div></article><article>Another</article></main>",
    }
    pages = spark.createDataFrame([(i, f"http://{k}.example/{i}", f"<html><body>{b}</body></html>") for k, b in bodies.items() for i in range(2)], "page_id long, url string, html string")
    found = {(r.url[7], r.page_id): r.text for r in html_text.extract_pages(pages).collect()}
    head, body = "A headline of some words", more.strip()
    want = {"a": f"{head} The lead. {body} End.", "b": f"{head} {body} The lead. short"} | dict.fromkeys("cde", f"{head} The lead. {body}") | {"f": f"{head} The lead. {body} Another"}
    assert found == {(k, i): want[k] for k in bodies for i in range(2)}


def test_html_of_the_tables(spark):
    for r in spark.read.parquet(f"{SF}/pages.parquet").join(queries.op10_html_text(spark, SF).select("page_id", "text", "n_chars"), "page_id").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1]
        plain = entities.unescape(re.sub(r"<[^>]+>", "", re.sub(r"</?(p|h1|br|div)[^>]*>", " ", inner)))
        assert r.text == " ".join(plain.split()) and r.n_chars == len(r.text)
