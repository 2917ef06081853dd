"""Results against plain Python: brute force, exact round trips, held-out accuracy."""

import html
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trackflow.llm import langid, mixing, neardup, neighbours, packing, quality, scoring, sharding
from trackflow.llm import text as tx
from trackflow.llm.components import components
from trackflow.llm.queries import QUERIES, vocabulary
from trackflow.llm.shared import stored

FOLDER = "/root/testdata/sf0.001"
BIGGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").toPandas()


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_words_and_hashes():
    texts = ["a bb  ccc", "", "\x0b x y \n", "bb a", "  "]
    words = tx.Words(*tx.buffers(pa.array(texts)))
    data = words.data.tobytes()
    got = [data[a:b].decode() for a, b in zip(words.starts, words.ends, strict=True)]
    assert got == ["a", "bb", "ccc", "x y", "bb", "a"] and words.counts.tolist() == [3, 0, 1, 2, 0]
    h = words.hashes()
    assert h[0] == h[5] and h[1] == h[4] and len(set(h.tolist())) == 4


def test_langid_held_out(spark):
    got = QUERIES["op1_langid"](spark, BIGGER).join(spark.read.parquet(f"{BIGGER}/documents.parquet"), "doc_id")
    held = got.where("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert held > 0.95
    assert got.where((F.col("held_out")) != (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)).count() == 0


def test_langid_kernel():
    """The product of presence matrix and weights equals kernel values with the landmarks."""
    rows = [("aa", "la le lu la le"), ("bb", "xo xi xu xo xi"), ("aa", "le la lo"), ("bb", "xu xa xi")]
    model = langid.train(rows, langid.Fit())
    names, scores, fits = langid.scores(pa.array(["la la le", "xo xu", "", "la le la le lo lu xo"]), model)
    assert names == ["aa", "bb", "und", "aa"] and scores[2] == 0 and (scores[:2] > 0.5).all()
    assert fits[2] == 0


def test_other_languages_do_not_fit(spark):
    """Texts in a language that was not learned fit none; held-out texts of learned ones do."""
    docs = spark.read.parquet(f"{BIGGER}/documents.parquet").where("lang is not null").toPandas()
    fold_of = docs.doc_id.map(lambda d: fold(d, 5))
    learned, other = docs[docs.lang != "es"], docs[docs.lang == "es"]
    rows = [(r.lang, r.text) for r in learned[fold_of != 0].itertuples() if len(r.text) < 1 << 14]
    model = langid.train(rows, langid.Fit())
    held = [t for t in learned[fold_of == 0].text if len(t) > 100]
    assert (langid.scores(pa.array(held), model)[2] >= 1).mean() > 0.98
    foreign = [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler.",
        "Все люди рождаются свободными и равными в своем достоинстве и правах.",
    ]
    assert (langid.scores(pa.array(foreign), model)[2] < 1).all()
    assert (langid.scores(pa.array([t for t in other.text if len(t) > 300]), model)[2] < 1).mean() > 0.9
    names, _, fits = langid.scores(pa.array(["some text"]), langid.train([("en", "123")], langid.Fit()))
    assert names == [langid.UNKNOWN] and np.isnan(fits).all()


def test_packing_round_trip(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    want = {d: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for d, t in zip(docs.doc_id, docs.text, strict=True)}
    rows = QUERIES["op3_packing"](spark, FOLDER).toPandas()
    for doc_id, pieces in rows.sort_values("start").groupby("doc_id"):
        at = 0
        for p in pieces.itertuples():
            ids = want[doc_id][at : at + p.length]
            assert p.start == at and p.doc_tokens == len(want[doc_id])
            assert p.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
            at += p.length
        assert at == len(want[doc_id])
    fill = []
    for _, pieces in rows.sort_values("offset").groupby("sequence_id"):
        assert (pieces.offset.to_numpy() == np.append(0, np.cumsum(pieces.length)[:-1])).all()
        fill.append(pieces.length.sum())
    assert max(fill) <= 2048 and sorted(rows.sequence_id.unique()) == list(range(len(fill)))
    assert np.mean(sorted(fill)[1:]) > 0.97 * 2048


def test_packing_is_optimal():
    rng = np.random.default_rng(3)
    for _ in range(30):
        places = np.append(0, np.cumsum(rng.integers(1, 6, 25)))
        penalties = rng.integers(0, 4, len(places)).astype(float)
        cuts = packing.best_cuts(places, penalties, 8)
        cost = [0.0] + [math.inf] * (len(places) - 1)
        for j in range(1, len(places)):
            for i in range(j):
                if places[j] - places[i] <= 8:
                    cost[j] = min(cost[j], cost[i] + 8 - (places[j] - places[i]) + penalties[j])
        at = dict(zip(places.tolist(), penalties.tolist(), strict=True))
        steps = np.diff([0, *cuts])
        assert steps.max() <= 8 and cuts[-1] == places[-1]
        assert sum(8 - s + at[c] for s, c in zip(steps, cuts, strict=True)) == pytest.approx(cost[-1])


def ppm(texts, text):
    """Plain prediction by partial matching, method C with exclusion."""

    def symbols(t):
        return [0] * scoring.ORDER + [b + 1 for b in t.encode()] + [scoring.END]

    counts = defaultdict(Counter)
    for t in texts:
        s = symbols(t)
        for i in range(scoring.ORDER, len(s)):
            for k in range(scoring.ORDER + 1):
                counts[tuple(s[i - k : i])][s[i]] += 1
    total, s = 0.0, symbols(text)
    for i in range(scoring.ORDER, len(s)):
        excluded, p = set(), 1.0
        for k in range(scoring.ORDER, -1, -1):
            live = {a: n for a, n in counts.get(tuple(s[i - k : i]), {}).items() if a not in excluded}
            if not live:
                continue
            n, u = sum(live.values()), len(live)
            if s[i] in live:
                p *= live[s[i]] / (n + u)
                break
            p *= u / (n + u)
            excluded |= live.keys()
        else:
            p /= scoring.ALPHABET - len(excluded)
        total += math.log10(p)
    return total


def test_scoring_against_plain(spark):
    training = ["abracadabra abraham", "abc abd abc", "é ab", "", "Abracadabra"]
    texts = ["abracadabra", "xyz", "é", "", "AAB abx", "abc abd abc"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = scoring.score(frame, spark.createDataFrame([(t,) for t in training], "text string"))
    got = {r.doc_id: r for r in got.collect()}
    lowered = [t.lower() for t in training]
    count = Counter(w for t in lowered for w in [*t.split(), "\0"])
    n, v = sum(count.values()), len(count)
    for i, t in enumerate(texts):
        words = [*t.lower().split(), "\0"]
        assert got[i].score == pytest.approx(ppm(lowered, t.lower()))
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(words), sum(w in count for w in words), n)
        assert got[i].base_score == pytest.approx(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words))


def test_scoring_in_pieces(spark):
    """Many buckets, tasks to a bucket, chunks and rows to a table give the plain scores, however large the corpus."""
    rng = np.random.default_rng(3)
    texts = [" ".join("".join(rng.choice(list("abcdé"), rng.integers(1, 6))) for _ in range(rng.integers(0, 30))) for _ in range(60)]
    rows = [(i, t, i % 5 != 1, True) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, train boolean, scored boolean").repartition(3)
    small = scoring.Sizes(bucket_bytes=300, salt_bytes=1500, chunk_bytes=400, chunk_keys=50, row_keys=7, piece_bytes=16)
    got = {r.doc_id: r for r in scoring.score_marked(frame, small).collect()}
    assert len(got) == len(texts)
    training = [t for i, t in enumerate(texts) if i % 5 != 1]
    for i, t in enumerate(texts):
        assert got[i].score == pytest.approx(ppm(training, t))
    # An n-gram that occurs once counts beside thousands of others.
    rare = spark.createDataFrame([(0, "the zyxwvu")], "doc_id bigint, text string")
    many = ["the the the"] * 3000 + ["zyxwvu"]
    one = scoring.score(rare, spark.createDataFrame([(t,) for t in many], "text string")).first()
    assert one.score == pytest.approx(ppm(many, "the zyxwvu")) and one.n_known == 3


def test_scoring_pieces_of_long_texts():
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("ab \n\té"), 900)), "x" * 500 + " a " + "y" * 333, " " * 400, "z" * 400, "ab " * 200 + "é" * 90]
    for text in texts:
        data, offsets = tx.buffers(pa.array([text]))
        keys, _, hashed, _ = next(scoring.pieces(data, offsets, 10**6))
        for size in (1, 7, 64):
            parts = list(scoring.pieces(data, offsets, size))
            assert len(parts) > 1 or " " not in text
            assert (np.concatenate([p[0] for p in parts]) == keys).all() and (np.concatenate([p[2] for p in parts]) == hashed).all()
            assert all(p[1][-1] == len(p[0]) and p[3][-1] == len(p[2]) for p in parts)


def test_scoring_sums_to_one():
    """Over all symbols, after any context."""
    keys, _ = scoring.grams(*tx.buffers(pa.array(["banana bandana", "ban the banana", "cabana"])))
    lengths = {}
    for k in range(1, scoring.ORDER + 2):
        lengths[k] = scoring._sums(keys & ((1 << (scoring.BITS * k)) - 1), np.ones(len(keys), np.int64))
    scorer = scoring.Scorer(scoring.build(lengths))
    for context in ("", "b", "ana", "xyzzy", "bana", " the"):
        key, _ = scoring.grams(*tx.buffers(pa.array([context])))
        every = (key[-1] >> scoring.BITS << scoring.BITS) + np.arange(1, scoring.ALPHABET + 1)
        assert (10 ** scorer.symbols(every)).sum() == pytest.approx(1.0, abs=1e-9)


def shingles(text):
    words = text.lower().split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1)))


def test_near_duplicates_against_all_pairs(spark, docs):
    got = neardup.near_duplicates(spark.read.parquet(f"{FOLDER}/documents.parquet")).toPandas()
    found = dict(zip(got.doc_id, got.class_id, strict=True))
    sets = {d: shingles(t) for d, t in zip(docs.doc_id, docs.text, strict=True)}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and (sets[a] & sets[b]).total() >= 0.8 * (sets[a] | sets[b]).total():
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert found == {d: find(d) for d in sets}


def test_signatures_estimate_weighted_similarity():
    a = " ".join(f"w{i}" for i in range(400))
    b = " ".join(f"w{i}" for i in range(40, 400)) + " w1 w2 w3 w4 w5" * 5
    words = tx.Words(*tx.buffers(pa.array([a, b, "one", a])))
    keys, bounds = neardup.strips(words, 5)
    s = neardup.signatures(keys, bounds, 1024)
    exact = (shingles(a) & shingles(b)).total() / (shingles(a) | shingles(b)).total()
    assert (s[0] == s[1]).mean() == pytest.approx(exact, abs=0.06) and (s[0] == s[3]).all() and not (s[0] == s[2]).any()


def test_copies_are_one_class(spark):
    """A group of copies that is most of the table, and a chain of near copies."""
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(base)) for i in range(300)]
    for i in range(300, 340):
        words = list(base)
        words[(i * 37) % 300] = f"new{i}"
        rows.append((i, " ".join(words)))
    rows += [(i, " ".join(f"x{i}_{j}" for j in range(50))) for i in range(400, 430)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).toPandas()
    classes = got.groupby("class_id").size().to_dict()
    assert classes == {0: 340, **{i: 1 for i in range(400, 430)}}


def test_every_pair_of_a_family_of_pages_is_compared(spark):
    """150 pages of one template, most pairs of them below the limit; blocks of few and of many texts."""
    rng = np.random.default_rng(11)
    changed = [set(rng.choice(40, 3, replace=False).tolist()) for _ in range(150)]
    texts = [" ".join(f"{'v' if k in c else 'w'}{k}_{j}" for k in range(40) for j in range(10)) for c in changed]
    sets, root = [shingles(t) for t in texts], list(range(150))
    for a in range(150):
        for b in range(a):
            if (sets[a] & sets[b]).total() >= 0.8 * (sets[a] | sets[b]).total():
                lo, hi = sorted((root[a], root[b]))
                root = [lo if r == hi else r for r in root]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for block in (8, 256):
        got = neardup.near_duplicates(frame, neardup.Plan(block=block)).toPandas()
        assert dict(zip(got.doc_id, got.class_id, strict=True)) == dict(enumerate(root))


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 101), (200, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 103: 100}


def test_mixing_targets_and_copies(spark):
    rows = [(i, "w " * (1 + i % 9), "a") for i in range(4000)] + [(i, "w w", "b") for i in range(4000, 4300)]
    rows += [(i, "w", "c") for i in range(5000, 5010)] + [(9000, "w w w", None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix(frame).toPandas()
    sizes = {s: int(g["size"].sum()) for s, g in got.fillna({"source": "~"}).groupby("source")}
    weights, whole, capped = {"a": 1, "b": 2, "c": 3, "~": 1}, sum(sizes.values()), set()
    while True:
        level = (whole - sum(3 * sizes[s] for s in capped)) / sum(w for s, w in weights.items() if s not in capped)
        more = {s for s, w in weights.items() if s not in capped and level * w > 3 * sizes[s]}
        if not more:
            break
        capped |= more
    for s, g in got.fillna({"source": "~"}).groupby("source"):
        target = 3.0 * sizes[s] if s in capped else level * weights[s]
        assert g.target.iloc[0] == pytest.approx(target)
        assert (g.copies * g["size"]).sum() == pytest.approx(target, rel=0.01, abs=9)
        assert g.copies.max() - g.copies.min() <= 1 and g.copies.max() <= 3
    again = mixing.mix(frame.repartition(7)).toPandas()
    assert again.sort_values("doc_id").copies.tolist() == got.sort_values("doc_id").copies.tolist()


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op7_toxicity"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = {(r.toxic, r.predicted): r["count"] for r in got.where("held_out").groupBy("toxic", "predicted").count().collect()}
    assert rows.get((0, 1), 0) < 0.03 * rows[(0, 0)]
    assert rows[(1, 1)] > rows[(1, 0)]


def test_neighbours_recall(spark):
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((900, 24)) * rng.uniform(0.5, 2, (900, 1))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    got = neighbours.search(frame, "vec_id % 20 = 0", neighbours.Plan(block_rows=300)).toPandas()
    hit = 0
    for q, g in got.groupby("query_id"):
        exact = (vectors * vectors[q]).sum(axis=1)
        assert g.sort_values("rank").score.to_numpy() == pytest.approx(exact[g.sort_values("rank").vec_id])
        exact[q] = -np.inf
        hit += len(set(np.argsort(-exact)[:20]) & set(g.vec_id))
    assert hit >= 0.95 * 20 * 45 and len(got) == 900


@pytest.mark.parametrize("blocks", [1, 3])
def test_neighbours_are_found_through_the_index(spark, blocks):
    """Recall and the share of vectors verified, on given vectors; a bound from one block prunes the others."""
    x = np.array(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").toPandas().embedding.tolist())
    ids, plan, work = np.arange(len(x)), neighbours.Plan(), neighbours.Work()
    unit = np.abs(x).max()
    norm = math.sqrt(np.square(x / unit).sum(axis=1).max()) * (1 + 1e-12)
    index = [neighbours.BlockIndex(ids[b::blocks], x[b::blocks], norm, unit, plan) for b in range(blocks)]
    hit = 0
    for q in range(0, len(x), 20):
        found, bound = [], -math.inf
        for block in index:
            found.append(next(block.search(ids[q : q + 1], x[q : q + 1], np.array([bound]), work)))
            bound = max(bound, np.sort(found[0][1])[-plan.k])
        scores = np.sort(np.concatenate([s for _, s in found]))[-plan.k :]
        exact = x @ x[q]
        exact[q] = -math.inf
        hit += (scores >= np.sort(exact)[-plan.k] - 1e-12).sum()
    assert hit >= 0.93 * plan.k * len(x) / 20
    # Small blocks give looser bounds.
    assert work.verified < (0.6 if blocks == 1 else 0.7) * work.possible


def test_neighbours_of_each_length(spark):
    """Vectors are compared within their length; huge entries do not overflow the index."""
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(3 if i < 30 else 5).tolist()) for i in range(60)]
    rows += [(i, (rng.standard_normal(2) * 1e200).tolist()) for i in range(60, 80)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = neighbours.search(frame, "vec_id % 10 = 0", neighbours.Plan(k=4)).toPandas()
    for lo, hi in ((0, 30), (30, 60), (60, 80)):
        for q in range(lo, hi, 10):
            own = got[got.query_id == q].sort_values("rank")
            with np.errstate(over="ignore"):
                exact = {i: float((np.array(v) * np.array(rows[q][1])).sum()) for i, v in rows[lo:hi] if i != q}
            assert len(own) == 4 and set(own.vec_id) <= set(exact)
            assert own.score.tolist() == pytest.approx([exact[i] for i in own.vec_id])


def test_jump_hash_moves_only_into_the_new_shard():
    keys = np.arange(20_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for n in (1, 7, 24):
        old, new = sharding.jump_hash(keys, n), sharding.jump_hash(keys, n + 1)
        moved = old != new
        assert (new[moved] == n).all() and abs(moved.mean() - 1 / (n + 1)) < 0.02
        assert np.bincount(old, minlength=n).min() > 0.85 * len(keys) / n


def test_sharding_digests(spark, docs):
    got = QUERIES["op9_sharding"](spark, FOLDER).toPandas().set_index("doc_id")
    for d, t in zip(docs.doc_id, docs.text, strict=True):
        assert (got["size"][d], got.text_crc32[d]) == (len(t.encode()) + 8, zlib.crc32(t.encode()))
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))


def test_extraction_against_the_article(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").toPandas().set_index("page_id")
    for r in QUERIES["op10_extraction"](spark, FOLDER).collect():
        article = re.search(r"<article>(.*?)(</article>|$)", pages.html[r.page_id], re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[a-zA-Z/][^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_store_survives(spark):
    frame = stored(spark.range(10).withColumn("r", F.rand()), "t")
    assert frame.collect() == frame.collect()


def test_frequent_lines_of_a_large_host(spark):
    """A line in 50 documents of a host of 20,000 is frequent, as in a small host; one in 30 is not."""
    big = spark.range(20_000).select(
        F.col("id").alias("doc_id"),
        F.concat(
            F.lit("own line number "), F.col("id"), F.lit(" of the text with enough different words to be kept as it is\n"),
            F.when(F.col("id") < 50, "Shared  LINE of fifty").otherwise(F.when(F.col("id") < 80, "shared line of thirty").otherwise("")),
        ).alias("text"),
        F.lit("big").alias("source"),
    )
    small = spark.range(40).select(
        (F.col("id") + 100_000).alias("doc_id"), F.concat(F.lit("shared line of forty\n\n own "), F.col("id")).alias("text"), F.lit("small").alias("source")
    )
    docs = big.unionByName(small).withColumns({"row": F.lit("own"), "clean": F.lit("own"), "host": F.lit("own"), "cut": F.lit("own")})
    removed = {r.doc_id: r.removed_words for r in quality.judge(docs).where("removed_words > 0").collect()}
    assert removed == {**{i: 4 for i in range(50)}, **{100_000 + i: 4 for i in range(40)}}
    stripped = quality.strip(docs)
    assert stripped.columns == docs.columns
    got = {r.doc_id: r.text for r in stripped.collect()}
    assert len(got) == 20_040 and got[0].endswith("kept as it is") and got[50].endswith("shared line of thirty")
    assert got[100_003] == "\n own 3"


def test_frequent_lines_of_a_small_host(spark):
    """Lines in 11 of up to 1,099 texts are frequent; in 1,100 texts, or in 10 of few, they are not."""
    def host(name, size, shared):
        own = F.concat(F.lit(f"own line of {name} "), F.col("id"), F.lit(" with enough different words to be kept as it is\n"))
        text = F.concat(own, F.when(F.col("id") < shared, "shared by all").otherwise(""))
        return spark.range(size).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit(name).alias("source"))

    docs = host("a", 1099, 11).unionByName(host("b", 1100, 11)).unionByName(host("c", 12, 10)).unionByName(host(None, 30, 30))
    removed = quality.judge(docs.withColumn("doc_id", F.concat_ws(" ", "source", "doc_id"))).where("removed_words > 0").collect()
    assert {r.doc_id: r.removed_words for r in removed} == {**{f"a {i}": 3 for i in range(11)}, **{f"{i}": 3 for i in range(30)}}


def test_strip_of_odd_rows(spark):
    rows = [(i, "A b\n\nsame\n x" if i % 2 else "SAME\nÉ same") for i in range(40)] + [(99, None), (99, ""), (98, "same"), (98, "same")]
    docs = spark.createDataFrame([(i, t, None) for i, t in rows], "doc_id bigint, text string, source string")
    got = [(r.doc_id, r.text) for r in quality.strip(docs, quality.Rules(max_docs=2)).collect()]
    assert len(got) == 44 and (99, None) in got and (99, "") in got and got.count((98, "")) == 2
    assert (1, "A b\n\n x") in got and (0, "É same") in got
    assert quality.strip(docs.limit(0)).collect() == []


def plain_jump(key, shards):
    """The published scalar form of jump consistent hashing."""
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_against_scalar():
    rng = np.random.default_rng(8)
    keys = np.append(rng.integers(0, 1 << 64, 500, dtype=np.uint64), np.array([0, 1, (1 << 64) - 1], np.uint64))
    for shards in (1, 2, 24, 25, 1000):
        assert sharding.jump_hash(keys, shards).tolist() == [plain_jump(int(k), shards) for k in keys]


def test_langid_against_plain_kernel_ridge():
    """Margins by sets of strings, a kernel matrix and a plain solution equal those of the sparse product."""
    rows = [("aa", "la le lu la le li"), ("bb", "xo xi xu xo xi"), ("aa", "le la lo, le!"), ("bb", "xu xa xi xe"), ("cc", "mir mor mur"), ("cc", "mur  mar")]
    new = ["la xo mir", "le le", "xi-xi", "mor mur la", "zz"]

    def grams_of(text):
        text = re.sub("[^a-z]+", " ", text.lower())
        found = {text[i : i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1)}
        return {g for g in found if g.strip()}

    def kernel(a, b):
        return len(a & b) / math.sqrt(len(a) * len(b))

    fit = langid.Fit()
    sets, names = [grams_of(t) for _, t in rows], sorted({n for n, _ in rows})
    label = np.array([names.index(n) for n, _ in rows])
    marks = np.array([[kernel(a, b) for b in sets] for a in sets])
    values, vectors = np.linalg.eigh(marks)
    sound = values > 1e-6 * values[-1]
    whiten = vectors[:, sound] / np.sqrt(values[sound])
    x, y = marks @ whiten, np.eye(len(names))[label]
    weight = (1 / np.bincount(label))[label][:, None]
    weight /= weight.sum()
    mean_x, mean_y = (weight * x).sum(axis=0), (weight * y).sum(axis=0)
    solved = np.linalg.solve(
        (x - mean_x).T @ (weight * (x - mean_x)) + fit.ridge / len(rows) * np.eye(x.shape[1]), (x - mean_x).T @ (weight * (y - mean_y))
    )
    got, scores, _ = langid.scores(pa.array(new), langid.train(rows, fit))
    for text, name, score in zip(new, got, scores, strict=True):
        own = grams_of(text)
        # N-grams of letters that no row has are known to none, but count for the length.
        margins = (np.array([kernel(own, s) for s in sets]) @ whiten - mean_x) @ solved + mean_y
        assert names[int(margins.argmax())] == name and score == pytest.approx(min(max(margins.max(), 0), 1), abs=1e-4)


def test_neighbours_and_languages_of_equal_texts(spark):
    """Ties: equal texts get equal predictions, whatever their row."""
    docs = spark.createDataFrame([(i, "la le li lo lu" if i % 2 else "xo xa xi", "aa" if i % 2 else "bb") for i in range(20)], "doc_id bigint, text string, lang string")
    rows = langid.identify(docs, docs).collect()
    assert len({(r.text, r.lang_pred, r.score) for r in rows}) == 2
