"""Corpus operators against brute force, exact round trips and held-out labels; each with odd rows and empty tables."""

import base64
import collections
import hashlib
import random
import re
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clipweave import storage
from clipweave.llm import bpe, chat, exact_dedup, fingerprint, jaccard, langid, line_dedup, mixing, quality, queries, secrets, shingles

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def docs_of(spark, folder=SF):
    return spark.read.parquet(f"{folder}/documents.parquet")


# -- 1


PIECE = re.compile(r"(?:\S{1,64}[^\S\n]*){1,4}|[^\S\n]+")


def multiset(text):
    return collections.Counter(text.split("\n")), collections.Counter(PIECE.findall(text))


def slow_fingerprints(spark, texts):
    """Vectors summed one by one in Python, from the hashes of single paragraphs and pieces."""
    items = sorted({(2, p) for t in texts for p in t.split("\n")} | {(1, p) for t in texts for p in PIECE.findall(t)})
    rows = spark.createDataFrame(items, "kind int, item string").select("kind", "item", *(F.when(F.col("kind") == 1, fingerprint.piece_hash(F.col("item"), k)).otherwise(fingerprint.piece_hash(F.col("item"), k + 2)).alias(f"h{k}") for k in (1, 2)))
    hashes = {(r["kind"], r["item"]): (r["h1"] % (1 << 64), r["h2"] % (1 << 64)) for r in rows.collect()}
    out = {}
    for t in texts:
        wide, lanes, held = [0] * 4, [0] * 128, multiset(t)
        for p, n in held[0].items():
            for k, h in enumerate(hashes[2, p]):
                wide[2 * k] += n * (h >> 32)
                wide[2 * k + 1] += n * (h & 0xFFFFFFFF)
        for p, n in held[1].items():
            for k, h in enumerate(hashes[1, p]):
                for j in range(32):  # the lanes of bits j + 32 and j are printed together
                    lanes[64 * k + 2 * j] += n * (h >> (32 + j) & 1)
                    lanes[64 * k + 2 * j + 1] += n * (h >> j & 1)
        out[t] = f"{sum(held[0].values()):08x}" + "".join(f"{x % (1 << 32):08x}" for x in wide) + f"{sum(held[1].values()):08x}" + "".join(f"{x % (1 << 16):04x}" for x in lanes)
    return out


def test_fingerprints_are_sums_of_paragraphs(spark):
    rng = random.Random(3)
    words = ["one", "two", "three", "four", "five", "é", "漢字", "x" * 150, "\t", " "]
    texts = ["", "\n", "one two\nthree", "three\none two", "one two\nthree\n"] + [" ".join(rng.choice(words) + rng.choice(["", "\n"]) for _ in range(rng.randint(0, 40))) for _ in range(40)]
    texts += ["\n".join(rng.sample(t.split("\n"), len(t.split("\n")))) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["fingerprint"] for r in fingerprint.fingerprints(df).collect()}
    want = slow_fingerprints(spark, texts)
    assert got == {i: want[t] for i, t in enumerate(texts)}
    for i, a in enumerate(texts):
        for j, b in enumerate(texts[:i]):
            assert (got[i] == got[j]) == (collections.Counter(a.split("\n")) == collections.Counter(b.split("\n")))


def test_fingerprint_algebra(spark):
    texts = ["one two three\nfour five", "four five\none two three", "four five", "one two three", "", "x\n\ny"]
    rows = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "doc_id long, x int, text string")
    f = {r["doc_id"]: r["f"] for r in fingerprint.fingerprints(rows).collect()}
    kind = fingerprint.fingerprints(rows).schema["f"].dataType
    from pyspark.sql.types import StructField, StructType

    one = spark.createDataFrame([tuple(f[i] for i in range(6))], StructType([StructField(c, kind) for c in "abcdef"]))
    p, col = fingerprint.printed, F.col
    got = one.select(
        (p(col("a")) == p(col("b"))).alias("order"), (p(col("a")) == p(fingerprint.plus(col("c"), col("d")))).alias("plus"), (p(col("d")) == p(fingerprint.minus(col("a"), col("c")))).alias("minus"),
        fingerprint.likeness(col("a"), col("b")).alias("same"), (p(col("a")) != p(col("d"))).alias("other"), (p(fingerprint.minus(fingerprint.plus(col("f"), col("a")), col("f"))) == p(col("a"))).alias("back"),
    ).first()
    assert got["order"] and got["plus"] and got["minus"] and got["same"] == 1.0 and got["other"] and got["back"]


def far_apart(a, b):
    """Squared differences of the counts of pieces, as a share of all pieces."""
    x, y = multiset(a)[1], multiset(b)[1]
    return sum((x[p] - y[p]) ** 2 for p in x | y) / max(1, x.total() + y.total())


def near(likeness, apart):
    return abs(1 - likeness - apart) <= 0.6 * apart or likeness == 0 and apart > 0.6


def edited_by_hand(rows):
    """rows: (doc_id, text) with distinct ids."""
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (key, text) in enumerate(rows):
        k, following = len(text) // 3, rows[(i + 1) % len(rows)][1]
        out[key] = text[: len(text) - k] + following[:k]
    return out


def test_op1(spark):
    rows = [(r["doc_id"], r["text"] or "") for r in docs_of(spark).collect()]
    want = edited_by_hand(rows)
    got = {r["doc_id"]: r for r in queries.op1_document_fingerprints(spark, SF).collect()}
    assert {k: r["edited_sha256"] for k, r in got.items()} == {k: sha(t) for k, t in want.items()}
    slow = slow_fingerprints(spark, {t for _, t in rows} | set(want.values()))
    following = dict(zip(sorted((k for k, _ in rows), reverse=True), sorted((k for k, _ in rows), reverse=True)[1:] + [max(k for k, _ in rows)]))
    texts = dict(rows)
    for k, t in rows:
        assert got[k]["fingerprint"] == slow[t] and got[k]["edited_fingerprint"] == slow[want[k]] and got[k]["n_chars"] == len(t)
        assert near(got[k]["near_edited"], far_apart(t, want[k])) and near(got[k]["near_next"], far_apart(t, texts[following[k]]))
    assert np.mean([r["near_edited"] for r in got.values()]) > 0.55 > 0.2 > np.mean([r["near_next"] for r in got.values()])


def test_op1_odd(odd, empty):
    got = fingerprint.with_edits(odd).collect()
    assert len(got) == odd.count() and sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in odd.collect())
    assert fingerprint.with_edits(empty).count() == 0
    assert all(len({r["edited_sha256"] for r in got if r["doc_id"] == i}) == 1 for i in (7, 10))
    alike = {r["doc_id"]: r["fingerprint"] for r in fingerprint.fingerprints(odd).collect()}
    assert alike[3] == alike[4] == "00000001" + alike[4][8:] and alike[1] == alike[2] != alike[11] and fingerprint.fingerprints(odd).where("doc_id = 10").count() == 2


# -- 2


def test_op2_held_out(spark):
    got = queries.op2_language_id(spark, "/root/testdata/sf0.01").join(docs_of(spark, "/root/testdata/sf0.01").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97 and all(0 <= r["score"] <= 1 for r in got)


def test_op2_odd(spark, odd, empty):
    plain = odd.drop("score", "lang_pred")
    got = {r["doc_id"]: r for r in langid.predict(plain, langid.fit(plain)).collect()}
    assert got[3]["lang_pred"] == got[4]["lang_pred"] == got[5]["lang_pred"] == got[9]["lang_pred"] == "und" and got[9]["score"] == 0
    assert got[7]["lang_pred"] in {"en", "de", "fr"}
    assert langid.fit(empty) is None and langid.predict(plain, None).where("lang_pred <> 'und'").count() == 0
    assert langid.predict(empty.drop("score", "lang_pred"), None).count() == 0


def test_all_languages_are_sampled(spark):
    rows = spark.createDataFrame([(i, f"text {i} of language {i % 90}", f"l{i % 90:02d}") for i in range(180)], "doc_id long, text string, lang string")
    windows, labels = langid.sample(rows, langid.TrainSpec(), "doc_id", "text", "lang")
    assert len(windows) == 180 and set(labels) == {f"l{i:02d}" for i in range(90)}


def test_compiled_network_is_the_network():
    rng = np.random.default_rng(1)
    windows = rng.integers(0, 256, (20, langid.WINDOW), dtype=np.uint8)
    net = langid.train(windows, ["a", "b"] * 10, langid.TrainSpec(epochs=1))
    at = langid.WINDOW - langid.WIDTHS[-1] + 1
    slow = np.concatenate([sum(net.filters[w][j][windows[:, j : j + at]] for j in range(w)).max(axis=1) for w in langid.WIDTHS], axis=1)
    assert np.allclose(slow, net.compiled().pooled(windows), atol=1e-4)


# -- 3


def test_targets_by_hand():
    assert mixing.targets([100, 100, 100], [5, 2, 1], 450, 2) == pytest.approx([200, 500 / 3, 250 / 3])
    assert sum(mixing.targets([10, 1000, 5, 0], [5, 2, 1, 5], 1500, 2)) == pytest.approx(1500)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 200), min_size=1, max_size=8), st.integers(1, 40), st.integers(0, 5))
def test_split_tree_is_exact(counts, shards, seed):
    out = mixing.split_tree(np.array(counts), shards, seed)
    assert (out >= 0).all() and out.sum(axis=0).tolist() == counts
    sizes = out.sum(axis=1)
    assert sizes.max() - sizes.min() <= np.log2(shards) + 2


def test_op3(spark):
    got = queries.op3_source_mix(spark, SF).collect()
    texts = {r["doc_id"]: r for r in docs_of(spark).collect()}
    size = {k: len(WORD.findall(r["text"] or "")) for k, r in texts.items()}
    total, taken, target = collections.Counter(), collections.Counter(), {}
    for r in got:
        source = texts[r["doc_id"]]["source"]
        assert r["size"] == size[r["doc_id"]] and r["taken"] <= 2 * r["size"]
        total[source] += r["size"]
        taken[source] += r["taken"]
        target[source] = r["target"]
    names = sorted(total)
    want = mixing.targets([total[n] for n in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5 * sum(total.values()), 2)
    for n, t in zip(names, want, strict=True):
        assert target[n] == pytest.approx(t) and abs(taken[n] - t) <= max(0.01 * t, 20)
    again = {r["doc_id"]: r["taken"] for r in queries.op3_source_mix(spark, SF).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}


def test_op3_mix_and_odd(odd, empty):
    plan = mixing.quotas(odd).collect()
    assert len(plan) == odd.count() and all(r["taken"] <= 2 * r["size"] for r in plan)
    clash = odd.drop("shard").withColumns({"size": F.lit(-5), "src": F.lit("s"), "place": F.lit("p"), "draws": F.lit(1)})
    mixed = mixing.mix(clash)
    assert mixed.columns == [*clash.columns, "shard"] and mixed.count() == sum(len(r["shards"]) for r in plan)
    assert {(r["size"], r["src"], r["place"], r["draws"]) for r in mixed.collect()} == {(-5, "s", "p", 1)}
    assert mixing.quotas(empty).count() == 0 and mixing.mix(empty.drop("shard")).count() == 0


def test_op3_is_what_the_leaves_hold(spark, monkeypatch):
    """Shards are of equal quota to within a block; another tree gives another mix of the same sizes."""
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 11)), f"s{i * i % 7}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    spec = mixing.MixSpec(shards=8, blocks_a_shard=20)
    shards = {r["doc_id"]: sorted(r["shards"]) for r in mixing.quotas(df, spec).collect()}
    mixed = collections.Counter((r["doc_id"], r["shard"]) for r in mixing.mix(df, spec).collect())
    assert mixed == collections.Counter((d, s) for d, held in shards.items() for s in held)
    size = {i: len(t.split()) for i, t, _ in rows}
    words = collections.Counter()
    for (d, s), n in mixed.items():
        words[s] += n * size[d]
    assert len(words) == 8 and max(words.values()) < 1.5 * min(words.values())
    seen = []
    real = mixing.split_tree
    monkeypatch.setattr(mixing, "split_tree", lambda counts, n, seed: seen.append(real(counts, n, seed)) or np.concatenate([counts[None], np.zeros((n - 1, len(counts)), np.int64)]))
    other = {r["doc_id"]: list(r["shards"]) for r in mixing.quotas(df, spec).collect()}
    assert {s for held in other.values() for s in held} == {0} and sum(map(len, other.values())) == sum(map(len, shards.values()))
    per_shard = seen[0].sum(axis=1)
    assert per_shard.max() - per_shard.min() <= 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 500), max_size=12), st.integers(1, 2500))
def test_nearest_sum(sizes, want):
    got = mixing.nearest(list(enumerate(sizes)), want)
    sums = {0}
    for x in (x for x in sizes if x < 2 * want):
        sums |= {x + y for y in sums}
    assert len(got) == len(set(got)) and abs(sum(sizes[i] for i in got) - want) == min(abs(x - want) for x in sums)


# -- 4


def test_long_candidates_are_covered_whole():
    slug = "/".join(["password", "setting", "response", "private", "example"] * 20)
    coverage = secrets.features("assigned", slug, "token=", "", "")[3]
    assert len(slug) > 800 and coverage == sum(c != "/" for c in slug) / len(slug)
    forest, long = secrets.fit(), [f for f in secrets.labelled_findings(3000, seed=98) if len(f[1]) > 200]
    score = forest.score(np.array([secrets.features(*f[:5]) for f in long]))
    assert len(long) >= 50 and np.mean((score >= 0.5) == np.array([f[5] == 1 for f in long])) > 0.97
    assert forest.score(np.array([secrets.features("assigned", slug, "token=", "", "")]))[0] < 0.5


def test_a_megabyte_is_scanned_in_seconds():
    import time

    began = time.perf_counter()
    for text in ("a+" * 500_000, "sk-" * 300_000, "password=" * 100_000, "-----BEGIN " * 90_000, "f" * 1_000_000 + "g"):
        sum(1 for _ in secrets.candidates(text))
    assert time.perf_counter() - began < 20
    key = "/aB3" + "x" * 30
    assert list(secrets.candidates(f"see {key}, or some/long/path/to/config/password=hunter22")) == [("mixed", 5, 4 + len(key)), ("assigned", 4 + len(key) + 2 + 37, 4 + len(key) + 2 + 45)]


def test_op4(spark, odd, empty):
    kinds = secrets.labelled_findings(600, seed=99)
    forest = secrets.fit()
    score = forest.score(np.array([secrets.features(*f[:5]) for f in kinds]))
    assert np.mean((score >= 0.5) == np.array([f[5] == 1 for f in kinds])) > 0.97
    got = {r["doc_id"] for r in queries.op4_secret_scan(spark, "/root/testdata/sf0.01").collect()}
    planted = re.compile(r'AKIA[0-9A-Z]{16}|(?:password|token)\s*=\s*"?[0-9a-f]{10,}')
    assert got == {r["doc_id"] for r in docs_of(spark, "/root/testdata/sf0.01").collect() if planted.search(r["text"] or "")}
    assert secrets.secrets(odd, forest).count() == 0 and secrets.secrets(empty, forest).count() == 0


# -- 5


def brute_components(rows, n, percent):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for key, text in rows:
        words = WORD.findall((text or "").translate(lower))
        sets[key] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())
    label = {k: k for k in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {k: (len(s), root(k)) for k, s in sets.items()}


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
def test_op5_brute_force(spark, n, percent):
    rng = random.Random(n)
    words = [f"w{i}" for i in range(400)]
    rows, shared = [], [rng.choice(words) for _ in range(60)]
    for base in range(25):
        text = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        if base % 3 == 0:
            text = text[:20] + shared + text[20:]
        for _ in range(rng.randint(1, 14)):  # near and exact copies, chains of edits
            rows.append(" ".join(text))
            text = list(text)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                text[rng.randrange(len(text))] = rng.choice(words)
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(df, jaccard.JoinSpec(words=n, percent=percent)).collect()}
    assert got == brute_components(rows, n, percent)
    cut = jaccard.join(df, jaccard.JoinSpec(words=n, percent=percent, chunk_rows=3, chunk_shingles=150, owner_values=100))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in cut.collect()} == got


def test_op5_sets_that_share_a_name(spark):
    """With names of three bits most sets share one; the result is the same."""
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9)))) for i in range(60)]
    rows += [(100 + i, t) for i, (_, t) in enumerate(rows[:20])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(df, jaccard.JoinSpec(words=2, percent=70, name_bits=3)).collect()}
    assert got == brute_components(rows, 2, 70)


def test_first_shingles_keep_every_link(spark):
    """Linked sets share a row of _first_prefixes, whatever blocks and owners they are dealt to."""
    rng = random.Random(5)
    words, rows = [f"w{i}" for i in range(60)], []
    for _ in range(12):
        text = [rng.choice(words) for _ in range(rng.randint(3, 90))]
        for _ in range(5):
            rows.append(" ".join(text))
            text[rng.randrange(len(text))] = rng.choice(words)
    spec = jaccard.JoinSpec(words=2, percent=80, owner_values=64)
    df = spark.createDataFrame(list(enumerate(rows)), "key long, body string").repartition(3)
    named = jaccard._name_pass(df, spec)
    held = collections.defaultdict(set)
    for r in jaccard._first_prefixes(named.where("kind = 1"), spec, np.zeros(0, np.uint64)).collect():
        held[r["sid"]].add(r["key"])
    name = {r["key"]: r["a"] for r in named.where("kind = 0").collect()}
    labels = brute_components(list(enumerate(rows)), 2, 80)
    sets = [set(zip(r.split(), r.split()[1:])) for r in rows]
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common) and name[i] != name[j]:
                assert labels[i][1] == labels[j][1] and held[name[i]] & held[name[j]]


@pytest.mark.parametrize("chunk_shingles", [90, 1 << 21])
def test_chunks_of_one_group(spark, chunk_shingles):
    """Documents of one group whose neighbours were not linked: the links are found within chunks and across them."""
    rng = np.random.default_rng(8)
    base = [rng.integers(1, 1 << 60, 40, dtype=np.uint64) for _ in range(6)]
    sets = [np.unique(np.concatenate([base[i % 6][: 40 - k], rng.integers(1, 1 << 60, k, dtype=np.uint64)])) for i, k in enumerate(rng.integers(0, 6, 60))]
    sizes = [len(s) for s in sets]
    near = {(a, b) for a in range(60) for b in range(a) if 100 * jaccard.overlap(sets[a], sets[b]) >= 80 * (sizes[a] + sizes[b] - jaccard.overlap(sets[a], sets[b]))}
    spec = jaccard.JoinSpec(percent=80, chunk_rows=4, chunk_shingles=chunk_shingles)
    rest = spark.createDataFrame([(7, i, sizes[i], i) for i in range(60)], "key long, comp long, n long, sid long")
    cut = jaccard.chunked(rest, spec)
    counts = {r["chunk"]: r["count"] for r in cut.groupBy("chunk").count().collect()}
    assert sum(counts.values()) == 60 and max(counts.values()) <= 4 and len(counts) >= 15
    marks = spark.createDataFrame([(i, jaccard.bitmap(s).tobytes()) for i, s in enumerate(sets)], "sid long, bits binary")
    pairs = {frozenset((r["a"], r["b"])) for r in jaccard.chunk_pairs(jaccard._root_pass(cut.join(marks, "sid")), 80).collect()}
    chunk = {r["sid"]: r["chunk"] for r in cut.collect()}
    assert {frozenset((chunk[a], chunk[b])) for a, b in near if chunk[a] != chunk[b]} <= pairs


def test_op5(spark):
    rows = [(r["doc_id"], r["text"]) for r in docs_of(spark).collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op5_ngram_jaccard_join(spark, SF).collect()}
    assert got == brute_components(rows, 4, 85)


def test_op5_odd(odd, empty):
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.join(odd, jaccard.JoinSpec(words=4, percent=85)).collect()]
    assert len(got) == odd.count()
    label = {d: c for d, _, c in got}
    assert label[1] == label[2] == label[11] == 1 and label[3] == 3 and label[None] is None and {n for d, n, _ in got if d in (3, 4, 5)} == {0}
    assert jaccard.join(empty).count() == 0
    kept = jaccard.keep_one(odd, jaccard.JoinSpec(words=4, percent=85))
    assert kept.columns == odd.columns and {1, 3, 4, 5, None} <= {r["doc_id"] for r in kept.collect()} and not {2, 11} & {r["doc_id"] for r in kept.collect()}


def test_signature_tree_keeps_every_link():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 60, 1060, dtype=np.uint64)  # about where bitmaps get wider
    sets = [np.unique(np.concatenate([base[: 1060 - k], rng.integers(0, 1 << 60, k // 2, dtype=np.uint64)])) for k in rng.integers(0, 250, 60)]
    sizes = np.array([len(s) for s in sets])
    left = {(min(int(a), int(b)), max(int(a), int(b))) for i, j in jaccard.candidate_pairs([jaccard.bitmap(s) for s in sets], sizes, np.arange(60), 80) for a, b in zip(i, j, strict=True)}
    for a in range(60):
        for b in range(a + 1, 60):
            common = jaccard.overlap(sets[a], sets[b])
            if 100 * common >= 80 * (sizes[a] + sizes[b] - common):
                assert (a, b) in left
    assert len({len(jaccard.bitmap(s)) for s in sets}) > 1


@given(st.lists(st.tuples(st.integers(0, 19), st.integers(0, 19)), max_size=30), st.integers(1, 4))
@settings(deadline=None)
def test_merged_parts_are_components(pairs, calls):
    part, brute = np.arange(20), list(range(20))
    for k in range(calls):
        some = np.array(pairs[k::calls], np.int64).reshape(-1, 2)
        part = jaccard.merged(part, some[:, 0], some[:, 1])
    for a, b in pairs:
        old, new = max(brute[a], brute[b]), min(brute[a], brute[b])
        brute = [new if x == old else x for x in brute]
    assert part.tolist() == brute


def test_bitmap_pass_names_parts(spark):
    """Documents that meet in two groups, among other strangers in each, are one unit with one membership."""
    rng = np.random.default_rng(8)
    base = np.sort(rng.integers(0, 1 << 62, 100).astype(np.uint64))
    sets = [base, np.unique(np.append(base[:95], np.uint64(7)))] + [np.unique(rng.integers(0, 1 << 62, 100).astype(np.uint64)) for _ in range(6)]
    units = [(unit, side, sid, len(sets[sid]), sid, jaccard.bitmap(sets[sid]).tobytes()) for unit, members in ((1, (0, 1, 2, 3)), (2, (0, 1, 4, 5, 6, 7))) for sid in members for side in [sid]]
    got = jaccard._bitmap_pass(spark.createDataFrame(units, "unit long, side long, comp long, n long, sid long, bits binary"), 80)
    rows = got.collect()
    assert sorted((r["side"], r["sid"]) for r in rows) == [(0, 0), (0, 0), (1, 1), (1, 1)]
    assert len({r["unit"] for r in rows}) == 2


def test_join_writes_few_files(spark):
    """Files in the shared folder don't grow with the input's partitions; what was kept besides is dropped like them."""
    shared, before = Path(spark.conf.get("spark.checkpoint.dir")), storage.written()
    rows = [(i, " ".join(f"w{i // 4 * 50 + k}" for k in range(40 + i % 4))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")

    def files(parts: int) -> int:
        old = set(shared.rglob("part-*"))
        got = {r["doc_id"]: r["component_id"] for r in jaccard.join(df.repartition(parts), jaccard.JoinSpec(words=4, percent=85)).collect()}
        assert got == {i: i // 4 * 4 for i in range(200)}
        return len(set(shared.rglob("part-*")) - old)

    assert files(24) <= files(2) + 4
    left = storage.written() - before
    assert any(path.startswith("kept:") for path in left)
    for path in left:
        storage.drop_stored(spark, path)
    assert not storage.written() - before


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_kept_joins_deal_frequent_keys_anew(spark, coalesce):
    """A join of kept tables on the key that one was grouped by: a frequent key isn't one task's."""
    confs = {"spark.sql.adaptive.coalescePartitions.enabled": coalesce, "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "25k"}
    old = {k: spark.conf.get(k) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        rows = storage.kept(spark.range(0, 100_000, 1, 4).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 100).alias("key"), F.xxhash64("id").alias("x")), "rows")
        least = jaccard.dealt(rows.groupBy("key").agg(F.min("x").alias("least")), "least")
        both = storage.kept(rows.join(least, "key").select("key", "x", "least", F.spark_partition_id().alias("part")), "both")
        assert both.count() == 100_000 and both.where("key = 0").select("part").distinct().count() > 1
        assert spark.conf.get("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning") == "false"
        storage.drop(rows, least, both)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100, 160)] + [(5, 900), (7, 7)], "a long, b long")
    got = {r["node"]: r["comp"] for r in jaccard.components(edges).collect()}
    assert set(got.values()) == {100, 5} and got[160] == 100 and got[900] == 5


@pytest.mark.parametrize("most", [3, 40, 1 << 20])
def test_components_with_more_edges_than_a_block(spark, most):
    """Blocks smaller than the graph: steps of stars go before; the result is the same."""
    rng = np.random.Generator(np.random.PCG64(3))
    edges = [(int(a), int(b)) for a, b in rng.integers(-400, 400, (300, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(jaccard.NULL_ID, 5000)]
    label = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = {r["node"]: r["comp"] for r in jaccard.components(spark.createDataFrame(edges, "a long, b long").repartition(4), most).collect()}
    assert got == label
    assert jaccard.components(spark.createDataFrame([], "a long, b long"), most).count() == 0


# -- 6


@pytest.fixture(scope="module")
def coder():
    import tiktoken

    path, pattern = queries.tokenizer()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return bpe.TreeBPE(path, pattern, text_leaf=8, piece_leaf=4), tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=80), st.lists(st.sampled_from(["a", "the", "é", " ", "  ", "\n", "'", "'s", "'re", "1", "!", "漢", "\t", "tion", "🙂"]), max_size=60).map("".join)))
def test_tree_bpe_is_tiktoken(coder, text):
    tree, library = coder
    text = text.encode("utf-8", "ignore").decode()
    ids = tree.encode(text)
    assert ids == library.encode_ordinary(text) and tree.decode(ids) == text.encode()


def test_own_leaf_is_the_library(coder):
    tree, library = coder
    rng = random.Random(4)
    for _ in range(300):
        data = bytes(rng.choice(b"abcde ionst'\xc3\xa9") for _ in range(rng.randint(1, 30)))
        assert bpe.TreeBPE.leaf(tree, data) == library._core_bpe.encode_single_piece(data)


def test_long_pieces(coder):
    tree, library = coder
    for text in ("a" * 3000, " " * 3000 + "x", "ab" * 2000, "'re" * 900):
        assert tree.encode(text) == library.encode_ordinary(text)


def test_op6(spark, odd, empty, coder):
    library = coder[1]
    texts = {r["doc_id"]: r["text"] or "" for r in docs_of(spark).collect()}
    for r in queries.op6_byte_bpe(spark, SF).collect():
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == sha(",".join(map(str, ids))) and r["decoded_sha256"] == sha(texts[r["doc_id"]])
    coded = bpe.decode(bpe.encode(odd, *queries.tokenizer(), exact_col="exact"), *queries.tokenizer())
    assert all(r["exact"] and bytes(r["decoded"]).decode() == (r["text"] or "") for r in coded.collect())
    assert bpe.encode(empty, *queries.tokenizer()).count() == 0


# -- 7


def brute_lines(rows, chars=20, docs=3):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(line_dedup.BLANKS).translate(lower)
    held = collections.defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            held[key(x)].add(-(1 << 63) if d is None else d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        me = -(1 << 63) if d is None else d
        stay = [x for x in lines if len(key(x)) < chars or len(held[key(x)]) < docs or me == max(held[key(x)])]
        out.append((str(d), len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out)


def test_op7(spark, empty):
    line = "  A line that is SHARED by many \t"
    rows = [(i, f"own {i}\n{line if i % 2 else line.lower()}\nÉTÉ {line}\n{line}") for i in range(12)] + [(None, line), (20, None), (21, ""), (22, "\n\n"), (23, "one " * 20000 + "\n" + line), (24, line + "\r")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got) == brute_lines(rows)
    assert line_dedup.dedup_lines(empty).count() == 0


def xxhash_twins(seed):
    """Two strings of 16 bytes that xxhash64 doesn't tell apart from this seed."""
    full, p1, p2, p4, p5 = (1 << 64) - 1, 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
    turned = lambda x, n: (x << n | x >> (64 - n)) & full
    mixed = lambda k: turned(k * p2 & full, 31) * p1 & full
    unmixed = lambda h: turned(h * pow(p1, -1, 1 << 64) & full, 33) * pow(p2, -1, 1 << 64) & full
    after = lambda k: (turned((seed + p5 + 16 & full) ^ mixed(k), 27) * p1 + p4) & full
    return [b"".join(x.to_bytes(8, "little") for x in two) for two in ((1, 3), (2, unmixed(mixed(3) ^ after(1) ^ after(2))))]


def test_second_hashes_are_not_made_of_first_ones(spark):
    """Of keys and pieces that clash in one 64-bit hash, the other hash still differs."""
    salts = spark.range(1).select(*(F.xxhash64(F.lit(i)) for i in (1, 2))).first()
    hashes = F.struct("key.*"), F.struct(*(fingerprint.piece_hash(F.col("x"), i).alias(f"h{i}") for i in (1, 2)))
    for seed, clash in ((42, "h1"), (salts[0] % (1 << 64), "h1"), (salts[1] % (1 << 64), "h2")):
        rows = spark.createDataFrame([(bytearray(x),) for x in xxhash_twins(seed)], "x binary").withColumn("key", line_dedup.key_hashes(F.col("x")))
        a, b = rows.select(*(h.alias(f"s{i}") for i, h in enumerate(hashes))).collect()
        if seed == 42:
            assert a["s0"][clash] == b["s0"][clash] and a["s0"]["h2"] != b["s0"]["h2"] and a["s1"] != b["s1"]
        else:
            assert a["s1"][clash] == b["s1"][clash] and a["s1"] != b["s1"]


def test_line_runs_anti_join_and_compact(spark):
    store = line_dedup.LineRuns(spark, fanout=2)
    batch = lambda rows: spark.createDataFrame(rows, "doc_id long, h1 long, h2 long")
    assert store.add(batch([(1, 10, 0), (2, 10, 0), (2, 11, 0)])).where("seen").count() == 0
    assert {r["h1"] for r in store.add(batch([(3, 10, 0), (3, 12, 0)])).where("seen").collect()} == {10}
    assert {r["h1"] for r in store.add(batch([(4, 12, 0), (4, 13, 0)])).where("not seen").collect()} == {13}
    assert [len(x) for x in store.levels] == [1, 1]
    assert {r["h1"]: (r["n"], r["top"]) for r in store.totals().collect()} == {10: (3, 3), 11: (1, 2), 12: (2, 4), 13: (1, 4)}


# -- 8


def test_op8(spark, odd, empty):
    folder = "/root/testdata/sf0.01"
    got = queries.op8_quality_classifier(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.95
    labels = spark.createDataFrame([(1, 1), (4, 0), (None, 1), (2, None)], "doc_id long, quality int")
    assert quality.predict(odd, quality.fit(odd, labels)).count() == odd.count()
    assert quality.fit(empty, labels) is None and quality.predict(odd, None).where("score <> 0.5").count() == 0


def test_boosting_learns():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    forest = quality.boost(x[:1500], y[:1500], quality.BoostSpec())
    assert ((forest.score(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95


# -- 9

PIECES = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "\\\\", " ", "\n", "[SYS]", "[ROLE=", "[ROLE", "[ROLE ", "[/ROLE]", '"', "x", "é", "</", "s>", "[INST", "]"]


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.sampled_from(["user", "assistant", "system", None, "tool", "</s>"]), st.text(max_size=5)), st.one_of(st.text(max_size=30), st.lists(st.sampled_from(PIECES), max_size=12).map("".join)))
def test_turn_round_trip(role, text):
    segment, a, b = chat.render_turn(role, text)
    assert chat.read(segment)[:2] == (role, text) and chat.unescape(segment[a:b]) == text
    if role in chat.MARKS:
        assert [m[2] for m in chat.CONTROL.finditer(segment) if not m[1]] == list(chat.MARKS[role])


CONTROLS = ["[SYS]", "[/SYS]", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE=", "[/ROLE]"]


def test_texts_at_the_edge_of_a_mark():
    """Texts that begin and end in every part of every control string, escaped or not."""
    edges = sorted({slash + c[i:j] for c in CONTROLS for i in range(len(c)) for j in range(i + 1, len(c) + 1) for slash in ("", "\\")}) + ["[ROLE ", "[ROLE=null]"]
    for role in ("user", "assistant", "tool", None):
        for edge in edges:
            for text in (edge, edge + "x", "x" + edge, edge + " x " + edge, " " + edge + " "):
                segment, a, b = chat.render_turn(role, text)
                got = chat.read(segment)
                assert got[:2] == (role, text) and got[4] == len(segment) and chat.unescape(segment[a:b]) == text


def test_op9(spark):
    got = {r["conv_id"]: r for r in queries.op9_chat_format(spark, SF).collect()}
    turns = collections.defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns[r["conv_id"]].append((r["role"], r["text"] or ""))
    turns[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    assert set(got) == set(turns)
    for key, said in turns.items():
        loss = "".join(t for r, t in said if r == "assistant")
        assert got[key]["formatted_chars"] == sum(len(chat.render_turn(r, t)[0]) for r, t in said)
        assert (got[key]["n_turns"], got[key]["turns_sha256"], got[key]["loss_chars"], got[key]["loss_sha256"]) == (len(said), sha("".join(f"{r}\n{t}\n" for r, t in said)), len(loss), sha(loss))


def test_op9_odd(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (None, 5, None, "</s>"), (2, None, "assistant", "b"), (2, 1, "assistant", "a" * 50000)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, segment string")
    segments = chat.render(df)
    got = {r["conv_id"]: r for r in chat.read_back(segments).collect()}
    assert got[1]["n_turns"] == 2 and got[None]["n_turns"] == 1 and got[2]["loss_chars"] == 50001
    assert {r["conv_id"]: len(r["formatted"]) for r in chat.whole(segments).collect()} == {k: r["formatted_chars"] for k, r in got.items()}
    assert chat.read_back(chat.render(df.limit(0))).count() == 0


# -- 10


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), max_size=300, unique=True), st.integers(1, 9))
def test_golomb_round_trip(values, owners):
    values, start = np.sort(np.array(values, np.uint64)), exact_dedup.owner_starts(owners)
    cut = [*np.searchsorted(values, start).tolist(), len(values)]
    for o in range(owners):
        part = values[cut[o] : cut[o + 1]]
        assert (exact_dedup.golomb_decode(exact_dedup.golomb_encode(part, int(start[o])), int(start[o])) == part).all()


def test_op10_brute_force(spark, odd, empty):
    for df in (docs_of(spark), odd):
        rows = [(r["doc_id"], r["text"] or "") for r in df.collect()]
        groups = collections.defaultdict(list)
        for d, t in rows:
            groups[t].append(-1 if d is None else d)
        got = exact_dedup.dedup(df).collect()
        assert len(got) == len(rows) and sum(r["kept"] for r in got) == len(groups)
        by_sha = {sha(t): ids for t, ids in groups.items()}
        for r in got:
            ids = by_sha[r["text_sha256"]]
            assert r["group_size"] == len(ids) and (-1 if r["keep_id"] is None else r["keep_id"]) == max(ids) and (not r["kept"] or r["doc_id"] == r["keep_id"])
        kept = exact_dedup.keep_one(df)
        assert kept.columns == df.columns and kept.count() == len(groups)
    assert exact_dedup.dedup(empty).count() == 0 and exact_dedup.keep_one(empty).count() == 0


def test_sql(spark):
    import duckdb

    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    for name, sql in queries.oracle_sql().items():
        mine, other = queries.queries()[name](spark, folder).toPandas(), con.sql(sql).df()
        cols = sorted(mine.columns)
        a, b = (x[cols].astype(str).sort_values(cols).reset_index(drop=True) for x in (mine, other))
        assert cols == sorted(other.columns) and a.equals(b), name


# -- shingles and pipeline


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aB é\t\n漢x", max_size=40), max_size=8), st.integers(1, 5))
def test_shingle_counts(texts, n):
    import pyarrow as pa

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    want = []
    for t in texts:
        words = WORD.findall(t.translate(lower))
        want.append(len({tuple(words[i : i + n]) for i in range(len(words) - n + 1)}) if len(words) >= n else int(bool(words)))
    assert [len(s) for _, sets in shingles.all_sets(pa.array(texts, pa.string()), n) for s in sets] == want


def test_pipeline(spark):
    import corpus_pipeline

    docs = docs_of(spark)
    first = docs
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        kept.append(docs.collect())
        assert docs.columns[: len(first.columns)] == first.columns, name
    texts = {r["doc_id"]: r["text"] for r in first.collect()}
    top = {t: max(k for k, x in texts.items() if x == t) for t in texts.values()}
    assert {r["doc_id"] for r in kept[1]} == {k for k in (r["doc_id"] for r in kept[0]) if top[texts[k]] == k}
    want = brute_components([(r["doc_id"], r["text"]) for r in kept[1]], 5, 80)
    assert {r["doc_id"] for r in kept[2]} == {k for k, (n, c) in want.items() if k == c}
    assert all(r["exact"] and len(r["token_ids"]) == r["n_tokens"] for r in kept[4]) and len(kept[4]) == len(kept[3])
    assert set(r["doc_id"] for r in kept[3]) <= {r["doc_id"] for r in kept[2]}


def test_pipeline_of_odd_rows(spark, odd, empty):
    import corpus_pipeline

    for df in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, SF)
        df.collect()
