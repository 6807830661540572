"""URL filters, fingerprints, language model and toxicity."""

import hashlib
import math
import os
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from regstar.llm import components, kneser_ney, minhash, toxicity, url_filters
from regstar.llm.queries import QUERIES, URL_RULES
from regstar.llm.shared import SharedTables
from tests.conftest import SF_MID, SF_SMALL
from tests.llm import brute
from tests.llm.conftest import pairs

# ------------------------------------------------------------- components


def test_components_of_paths_stars_and_rings(spark):
    rng = np.random.default_rng(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 600)]
    links += [(int(a), int(b)) for a, b in rng.integers(1000, 1400, (250, 2))] + [(7, 7), (900, 901), (901, 900)]
    edges = spark.createDataFrame([*links, (None, 3), (4, None)], "a long, b long")
    shared = SharedTables(spark, "test")
    got = dict(pairs(components.connected_components(edges, shared), "node", "component"))
    nodes = {n for e in links if e[0] != e[1] for n in e}
    assert got == brute.components([e for e in links if e[0] != e[1]], nodes)
    empty = components.connected_components(edges.limit(0), SharedTables(spark, "test"))
    assert empty.count() == 0


# ------------------------------------------------------------------- URLs


def link(href: str) -> str:
    return f'<html><head><link rel="canonical" href="{href}"></head></html>'


PAGES = [
    (1, "https://blog.example.com/en/1", "<p>", "com/ is longer only by host", "example.com/en/", "block"),
    (2, "http://WWW.Example.COM/en/2?x#y", None, "", "www.example.com/en/", "allow"),
    (3, "https://a.example.com/de/3", "", "", "com/", "allow"),
    (4, "https://a.example.net/es/4", "", "", "net/es/", "block"),
    (5, "https://b.example.org/5", link("https://a.example.net/es/4/?utm_source=z"), "alias", None, "block"),
    (6, "https://c.example.org/6", '<META content="0; URL=//b.example.org/5#t" HTTP-EQUIV="Refresh">', "", None, "block"),
    (7, "https://d.example.org/7", link("https://www.example.com/en/9"), "allowed alias", None, "allow"),
    (8, "https://e.example.org/8", link("/7x") + link("http://d.example.org/7"), "", None, "allow"),
    (9, "https://f.example.org/x/9", link("10"), "", None, "block"),
    (10, "https://f.example.org/x/10", link("https://x.net/fr/1"), "", None, "block"),
    (11, "https://x.net/fr/1", link("https://www.example.com/en/9"), "own rule wins", "net/fr/", "block"),
    (12, None, link("https://x.net/fr/1"), "", None, "allow"),
    (13, "no host", "", "", None, "allow"),
    (14, "https://net", "", "", None, "allow"),
    (15, "ftp://notexample.org/es/", "", "", None, "allow"),
    (15, "ftp://notexample.org/es/", "", "", None, "allow"),
    (None, "https://g.example.org/a&b?q=1&ref=2", "", "", None, "allow"),
    (16, "://example.net/fr/", "", "", "net/fr/", "block"),
    (17, "https://g.example.org/b?b=2&a=1", link("https://h.net/es/?u"), "", None, "block"),
    (18, "http://g.example.org/b/?a=1&utm_medium=m&b=2", "", "same node as 17", None, "block"),
    (19, "http://slash.net/fr", link("http://slash.net/fr/"), "an edge to itself: its alias is blocked", None, "block"),
    (20, "http://slash.net/fr?ref=1", "", "the same node", None, "block"),
    (21, "http://plain.net/fr", "", "no edge touches it", None, "allow"),
    (22, "http://q.net/de/e", link("../fr/f"), "a folder up", None, "block"),
    (23, "http://r.net/de/./x/../e/", link("./../../fr/../fr/./f#top"), "", None, "block"),
    (24, "http://r.net/de/e", "", "same node as 23", None, "block"),
    (25, "http://s.net/de/up", link("../../../../es/x"), "no folder above the root", None, "block"),
    (26, "http://t.net/de/q?a=1", link("?page=2"), "the query alone", None, "block"),
    (27, "http://t.net/de/q?page=2", link("//u.net/es/"), "", None, "block"),
    (28, "http://v.net/de/here", link("#part"), "itself", None, "allow"),
]


def test_url_verdicts(spark):
    pages = spark.createDataFrame([r[:3] + ("x",) for r in PAGES], "page_id long, url string, html string, node string")
    rows = [r for r in PAGES if r[0] not in (9, 10)] + [r[:5] + ("allow",) for r in PAGES if r[0] in (9, 10)]
    # x.net/fr/1 is an alias of an allowed URL, and so are 9 and 10; it keeps its own rule.
    got = url_filters.judge_urls(pages, URL_RULES)
    assert sorted(pairs(got, "page_id", "rule", "verdict"), key=repr) == sorted(((r[0], r[4], r[5]) for r in rows), key=repr)
    without = [r for r in PAGES if r[0] != 11]
    some = spark.createDataFrame([r[:3] for r in without], "page_id long, url string, html string")
    got = dict(pairs(url_filters.judge_urls(some, URL_RULES), "page_id", "verdict"))
    assert got[9] == got[10] == "block"
    sent = spark.createDataFrame([("http://z.net/fr/", "ftp://notexample.org/es")], "from_url string, to_url string")
    got = dict(pairs(url_filters.judge_urls(some, URL_RULES, redirects=sent), "page_id", "verdict"))
    assert got[15] == "block" and got[13] == "allow"
    assert url_filters.judge_urls(some.limit(0), URL_RULES).count() == 0


def test_urls_against_sql(spark, tmp_path):
    import duckdb

    from regstar.llm.oracles import ORACLE_SQL

    pages = spark.createDataFrame([r[:3] for r in PAGES if r[0] != 11], "page_id long, url string, html string")
    got = url_filters.judge_urls(pages, URL_RULES)
    pages.coalesce(1).write.parquet(str(tmp_path / "pages"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages/*.parquet')")
    want = con.execute(ORACLE_SQL["op1_url_filters"]).fetchall()
    assert sorted(pairs(got, *got.columns), key=repr) == sorted(want, key=repr)
    assert sum(r[5] is not None for r in want) > 15


@pytest.mark.parametrize("path", ["", "/", "/a", "/a/b", "/./a", "/a/..", "/../a/", "/a/./b/../../c", "/..a/.b/...", "/a//../b"])
def test_dot_segments(spark, path):
    from urllib.parse import urljoin

    got = spark.range(1).select(url_filters.node_of(F.lit("http://h" + path))).first()[0]
    assert got == urljoin("http://h/", "http://h" + path if "/." not in path else path).removeprefix("http://").rstrip("/")


# ----------------------------------------------------------- fingerprints


def shingles(text: str) -> set:
    words = text.encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("which", ["odd_docs", "small_docs", "no_docs"])
def test_fingerprints_against_python(request, which):
    docs = request.getfixturevalue(which)
    rows = sorted(((d, t or "") for d, t in pairs(docs, "doc_id", "text")), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    got = pairs(minhash.fingerprint_documents(docs, rows_per_range=7), *(c.split()[0] for c in minhash.RESULT.split(", ")))
    hasher, want = minhash.MinHasher(5), []
    for i, (d, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        new = t[: len(t) - half] + after[:half]
        a, b, c = hasher.bits(t), hasher.bits(new), hasher.bits(after)
        want.append((d, len(t), hashlib.sha256(new.encode()).hexdigest(), hasher.packed(a), hasher.packed(b), hasher.likeness(a, b), hasher.likeness(a, c)))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_likeness_estimates_jaccard(spark, small_docs):
    texts = [t for _, t in pairs(small_docs, "doc_id", "text")]
    hasher, errors = minhash.MinHasher(5), []
    for a, after in zip(texts, texts[1:]):
        for share in (4, 10, 50):
            cut = len(a) - len(a) // share
            b = a[:cut] + after[: len(a) // share]
            x, y = shingles(a), shingles(b)
            if x and len(x | y) > 20:
                errors.append(hasher.likeness(hasher.bits(a), hasher.bits(b)) - len(x & y) / len(x | y))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.06
    bits = hasher.bits(texts[0])
    assert (minhash.unpacked(hasher.packed(bits)) == bits).all() and minhash.unpacked("") is None


# ---------------------------------------------------------- language model


def kn_scores(train: list[str], texts: list[str]) -> list[tuple]:
    """(n_tokens, n_known, N, base_score, score) by dictionaries."""
    tokens = lambda t: brute.WORD.findall(brute.lower(t or "")) + [None]
    c, pair = Counter(), Counter()
    for t in train:
        before = "<s>"
        for w in tokens(t):
            c[w] += 1
            pair[before, w] += 1
            before = w
    kinds, total, followers = Counter(), Counter(), defaultdict(Counter)
    for (v, w), n in pair.items():
        kinds[w] += 1
        total[v] += n
        followers[v][min(n, 3)] += 1
    count = lambda xs: [sum(x == k for x in xs) for k in (1, 2, 3, 4)]
    d, d1 = kneser_ney.discounts(*count(pair.values())), kneser_ney.discounts(*count(kinds.values()))
    n, v_size, k_sum = sum(c.values()), len(c), len(pair)
    rest = sum(d1[min(k, 3)] for k in kinds.values()) / k_sum / (v_size + 1) if k_sum else 1 / (v_size + 1)
    out = []
    for t in texts:
        base = score = 0.0
        before = "<s>"
        for w in tokens(t):
            base += math.log10((c[w] + 1) / (n + v_size + 1))
            p = max(kinds[w] - d1[min(kinds[w], 3)], 0) / max(k_sum, 1) + rest
            if total[before]:
                left = sum(d[k] * m for k, m in followers[before].items())
                p = (max(pair[before, w] - d[min(pair[before, w], 3)], 0) + left * p) / total[before]
            score += math.log10(p)
            before = w
        out.append((len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, base, score))
    return out


@pytest.mark.parametrize("which", ["odd_docs", "small_docs"])
def test_scores_against_dictionaries(request, which, monkeypatch):
    docs = request.getfixturevalue(which)
    rows = pairs(docs, "doc_id", "text")
    held = lambda d: d is not None and brute.crc(str(d)) % 7 == 2
    out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2
    got = kneser_ney.score_documents(docs, lambda _: out, shard_bytes=2000).collect()
    want = [(d, held(d), *s) for (d, _), s in zip(rows, kn_scores([t for d, t in rows if not held(d)], [t for _, t in rows]))]
    for a, b in zip(sorted(got, key=repr), sorted(want, key=repr)):
        assert tuple(a)[:5] == b[:5]
        assert tuple(a)[5:7] == pytest.approx(b[5:], rel=1e-9)


def trigram_scores(train: list[str], texts: list[str]) -> list[float]:
    tokens = lambda t: ["<s>", "<s>", *brute.WORD.findall(brute.lower(t or "")), None]
    grams = lambda t: list(zip(tokens(t), tokens(t)[1:], tokens(t)[2:]))
    tri = Counter(g for t in train for g in grams(t))
    two = Counter(g[1:] for g in tri)
    one = Counter(w for _, w in two)
    tables = [Counter({(w,): n for w, n in one.items()}), two, tri]
    d = [kneser_ney.discounts(*(sum(n == k for n in c.values()) for k in (1, 2, 3, 4))) for c in tables]
    total, left = [Counter() for _ in d], [Counter() for _ in d]
    for c, t, r, dk in zip(tables, total, left, d):
        for g, n in c.items():
            t[g[:-1]] += n
            r[g[:-1]] += dk[min(n, 3)]
    out = []
    for text in texts:
        score = 0.0
        for g in grams(text):
            p = 1 / (len(one) + 1)
            for k, (c, dk) in enumerate(zip(tables, d)):
                x = g[2 - k :]
                if total[k][x[:-1]]:
                    p = (max(c[x] - dk[min(c[x], 3)], 0) + left[k][x[:-1]] * p) / total[k][x[:-1]]
            score += math.log10(p)
        out.append(score)
    return out


@pytest.mark.parametrize("which", ["odd_docs", "small_docs"])
def test_trigram_scores_against_dictionaries(request, which):
    docs = request.getfixturevalue(which)
    rows = pairs(docs, "doc_id", "text")
    held = lambda d: d is not None and brute.crc(str(d)) % 7 == 2
    out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2
    got = kneser_ney.score_documents(docs, lambda _: out, order=3, shard_bytes=2000).collect()
    want = trigram_scores([t for d, t in rows if not held(d)], [t for _, t in rows])
    assert sorted((r.doc_id or -1, round(r.score, 6)) for r in got) == sorted((d or -1, round(s, 6)) for (d, _), s in zip(rows, want))


def test_probabilities_of_a_history_sum_to_one(spark, small_docs):
    shared = SharedTables(spark, "test")
    texts = small_docs.select("text").limit(40).coalesce(1)
    model = kneser_ney.train(texts, shared)
    scorer, tokens = kneser_ney.Scorer(model), kneser_ney.Tokens()
    every = np.unique(np.concatenate([tokens.of(t) for (t,) in pairs(texts, "text")]))
    assert len(every) == model.words
    _, lower = scorer.words(every)
    assert lower.sum() + model.unseen == pytest.approx(1)
    for history in (kneser_ney.BEGIN, every[0], every[len(every) // 2], np.uint64(1)):
        p = scorer.pairs(np.full(len(every), history), every, lower)
        assert 0.9 < p.sum() < 1 and (p > 0).all()


def test_grams_of_a_level_are_found_in_its_file(tmp_path):
    rng = np.random.default_rng(5)
    words = rng.integers(1, 2**63, 80_000, dtype=np.uint64)  # places need more than two bytes
    h = rng.integers(1, 2**63, 30_000, dtype=np.uint64)
    of, w = h[rng.integers(0, 30_000, 90_000) ** 2 // 30_000], words[rng.integers(0, 80_000, 90_000)]
    grams = {(int(a), int(b)): 1 + i % 2 + 254 * (i % 5 == 0) * (i % 7) for i, (a, b) in enumerate(zip(of, w))}
    grams |= {(int(h[-1]), int(b)): 1 for b in words}  # a history before every word
    followers = defaultdict(list)
    for (a, _), n in grams.items():
        followers[a].append(n)
    of, w = (np.array([g[i] for g in grams], np.uint64) for i in (0, 1))
    path = str(tmp_path / "near-3-0")
    kneser_ney.Level.write(path, of, w, np.array(list(grams.values())))
    asked = list(grams) + [(int(a), int(b)) for a, b in zip(of[::3], w[::-3])] + [(1, int(w[0])), (int(of[0]), 2), (3, 4)]
    got = kneser_ney.Level(*kneser_ney.map_arrays(path)).find(*(np.array([g[i] for g in asked], np.uint64) for i in (0, 1)))
    numbers = {a: (sum(n), n.count(1), n.count(2), len(n) - n.count(1) - n.count(2)) for a, n in followers.items()}
    want = [(grams.get(g, 0), *numbers.get(g[0], (0, 0, 0, 0))) for g in asked]
    assert [tuple(map(int, x)) for x in zip(got[0], got[1], *got[2])] == want
    assert kneser_ney.map_arrays(str(tmp_path / "none")) is None


def test_disk_of_the_language_model(spark, small_docs):
    shared = SharedTables(spark, "test")
    texts = [t or "" for (t,) in pairs(small_docs, "text")]
    kneser_ney.train(small_docs.select(F.coalesce("text", F.lit("")).alias("text")), shared, order=3)
    root = kneser_ney.local_path(shared.root)
    grams, tokens = set(), kneser_ney.Tokens()
    for t in texts:
        x = [0, 0, *tokens.of(t).tolist()]
        grams |= set(zip(x, x[1:], x[2:]))
    levels = [{g[k:] for g in grams} for k in (0, 1)]
    plain = sum(12 * len(g) + 24 * len({x[:-1] for x in g}) for g in levels)  # hashes and numbers as they are
    size = sum(os.path.getsize(f"{root}/model/{f}") for f in os.listdir(f"{root}/model") if "words" not in f)
    assert size < 0.75 * plain
    # Nothing else stays but the few rows of the word shards' sums.
    assert sorted(os.listdir(root)) == ["model", "words"]


def test_rounds_share_the_grams_out():
    texts = ["a b c a b", "", "b c d e f g h a b c", "c c c c"] * 3
    frequent = {2: np.array([kneser_ney.BEGIN]), 3: np.zeros(0, np.uint64)}
    batch = [pa.RecordBatch.from_pydict({"text": texts})]
    shards, total = [], 0
    for part in range(kneser_ney.PARTS):
        for rows in kneser_ney._count_grams(32, frequent, 3, part)(iter(batch)):
            shards += rows.column(0).to_pylist()
            assert {s % kneser_ney.PARTS for s in rows.column(0).to_pylist()} <= {part}
            total += sum(int(kneser_ney._unpack_grams(b, 3)[2].sum()) for b in rows.column(1).to_pylist())
    assert len(shards) == len(set(shards)) and total == sum(len(t.split()) + 1 for t in texts)


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    def left() -> set[str]:
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size())}

    def write(name: str) -> None:
        spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count().write.parquet(str(tmp_path / name))

    before = left()
    with kneser_ney.shuffle_files_removed(spark):
        write("inside")
    until = time.time() + 20
    while (more := left() - before) and time.time() < until:
        time.sleep(0.2)
    assert not more
    write("outside")
    assert left() - before


def test_language_model_query_and_edges(spark, no_docs):
    got = QUERIES["op6_lm_scoring"](spark, SF_SMALL).collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 10 and sum(r.score for r in held) > sum(r.base_score for r in held)
    assert kneser_ney.score_documents(no_docs, lambda d: d > 0).count() == 0
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    rows = sorted(map(tuple, kneser_ney.score_documents(docs, lambda d: d > 0).collect()))
    assert [r[:7] for r in rows] == [(1, True, 3, 0, 0, 0.0, 0.0), (2, True, 1, 0, 0, 0.0, 0.0)]


# -------------------------------------------------------------- toxicity


def test_toxicity_finds_held_out_toxic_documents(spark):
    rows = {r.doc_id: r for r in QUERIES["op8_toxicity"](spark, SF_MID).collect()}
    labels = dict(pairs(spark.read.parquet(f"{SF_MID}/labels.parquet"), "doc_id", "toxic"))
    held = [(r.score, r.predicted, labels[d]) for d, r in rows.items() if r.held_out and d in labels]
    assert all(brute.crc(str(d)) % 3 == 1 for d, r in rows.items() if r.held_out)
    toxic = [p for _, p, y in held if y]
    clean = [p for _, p, y in held if not y]
    assert np.mean(toxic) > 0.7 and np.mean(clean) < 0.02
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())


INSULTS = ["scoundrel", "wretch", "villain", "rascal", "knave"]


def biased_labels(n=900, seed=0):
    """Texts whose labels have a spurious link with a group's name: no word
    tells toxic texts from others, and most mentions of the group are toxic."""
    rng = np.random.default_rng(seed)
    words = [f"word{i}" for i in range(60)]
    texts, toxic = [], []
    for i in range(n):
        t, bad = set(rng.choice(words, 8)), i % 3 == 0
        if rng.random() < (0.7 if bad else 0.04):
            t.add(INSULTS[rng.integers(len(INSULTS))])
        if rng.random() < (0.6 if bad else 0.06):
            t.add("muslim")
        texts.append(t)
        toxic.append(int(bad))
    return texts, toxic


def neutral_mentions(n=300, seed=9):
    rng = np.random.default_rng(seed)
    return [" ".join([*rng.choice([f"word{i}" for i in range(60)], 8), "muslim"]) for _ in range(n)]


def test_counterfactuals_take_a_learnt_bias_away():
    texts, toxic = biased_labels()
    plain = toxicity.Scorer(*toxicity.train(texts, toxic, counterfactual=0.0))
    fair = toxicity.Scorer(*toxicity.train(texts, toxic))
    swaps = [(t, t.replace("muslim", "christian")) for t in neutral_mentions()]
    gap = {m: np.mean([m.score(a) - m.score(b) for a, b in swaps]) for m in (plain, fair)}
    assert gap[plain] > 0.1, "the bias is there to be learnt"
    assert abs(gap[fair]) < 0.1 * gap[plain]
    # Neutral mentions that the query's threshold takes for toxic.
    wrong = {m: sum(m.score(a) >= 0.7 for a, _ in swaps) for m in (plain, fair)}
    assert wrong[plain] > 200 and wrong[fair] < 0.1 * wrong[plain], list(wrong.values())
    # What the texts say themselves still counts, with or without a mention.
    assert all(fair.score(f"word1 {insult} word2") >= 0.7 for insult in INSULTS)
    assert all(fair.score(f"word1 {insult} muslim") >= 0.7 for insult in INSULTS)


@pytest.mark.parametrize("counterfactual", [0.0, 1.0])
def test_training_finds_the_least_loss(counterfactual):
    """Against plain proximal gradient descent on dense matrices."""
    texts, toxic = biased_labels(150, seed=3)
    sparse = 2e-3
    weights, intercept = toxicity.train(texts, toxic, counterfactual=counterfactual, sparse=sparse)
    features = [[f for w in t for f in toxicity.features_of(w)] for t in texts]
    pairs_ = toxicity.counterfactuals(texts)
    often = Counter(f for fs in features for f in set(fs))
    terms = {f for kind in toxicity.IDENTITY_TERMS.values() for t in kind for f in toxicity.features_of(t)}
    names = sorted({f for f, n in often.items() if n >= 3} | terms)
    number = {f: i for i, f in enumerate(names)}

    def row(words):
        out = np.zeros(len(names))
        for w in words:
            for f in toxicity.features_of(w):
                if f in number:
                    out[number[f]] += 1
        return out

    x, y = np.array([row(t) for t in texts]), np.array(toxic, float)
    change = np.array([row(b) - row(a) for a, b in pairs_])
    each = np.where(y > 0, 3.0, 1.0)
    each /= each.sum()

    def loss(w, b):
        z = x @ w + b
        fit = (each * (np.logaddexp(0, z) - y * z)).sum()
        return fit + counterfactual / 2 * ((change @ w) ** 2).mean() + sparse * np.abs(w).sum()

    w, b = np.zeros(len(names)), 0.0
    step = 1 / (np.linalg.norm(np.sqrt(each)[:, None] * np.c_[x, np.ones(len(x))], 2) ** 2 / 4
                + counterfactual * np.linalg.norm(change, 2) ** 2 / len(change))
    for _ in range(30_000):
        error = each * (1 / (1 + np.exp(-(x @ w + b))) - y)
        w = w - step * (x.T @ error + counterfactual * change.T @ (change @ w) / len(change))
        w, b = np.sign(w) * np.maximum(np.abs(w) - step * sparse, 0), b - step * error.sum()
    got = np.array([weights.get(f, 0.0) for f in names])
    assert abs(loss(got, intercept) - loss(w, b)) < 5e-4 < 0.1 * loss(np.zeros(len(names)), intercept)
    if counterfactual:  # and it is another optimum than without the pairs
        other, at = toxicity.train(texts, toxic, counterfactual=0.0, sparse=sparse)
        assert loss(np.array([other.get(f, 0.0) for f in names]), at) > loss(got, intercept) + 0.01


def test_toxicity_edges(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, None), (None, 1), (999, 1)], "doc_id long, toxic int")
    got = toxicity.score_documents(odd_docs, labels, lambda d: d >= 0).collect()
    assert len(got) == odd_docs.count() and len({r.score for r in got}) == 1
    assert toxicity.score_documents(odd_docs, labels.limit(0), lambda d: d >= 0).first().score == 0.5
    assert toxicity.score_documents(no_docs, labels, lambda d: d >= 0).count() == 0


def test_labels_without_documents_take_no_place(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    got = toxicity.labelled_sample(docs, labels, lambda d: d >= 0, 15)
    assert len(got) == 15 and set(got.text) <= {f"text {i}" for i in range(20)}
