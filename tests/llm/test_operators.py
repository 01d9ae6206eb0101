"""Operators against brute force, the tokenizers library and held-out rows."""

import collections
import hashlib
import math
import random
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import bpe, decontaminate, graph, jaccard, language, lines, pii, quality, queries, sharding, substring, vectors, words
from tests.check import compare, connect

PATH = public_tokenizers.path("word_bpe_49k.json")
SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_sql(spark, sf_dir, name):
    df = queries.queries()[name](spark, sf_dir)
    assert compare(df, connect(sf_dir), queries.oracle_sql()[name]) is None


def corpus(seed, n=120):
    """Texts with copies, edited copies and shared passages."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 4)))
    passage = [word() for _ in range(70)]
    out = []
    for _ in range(n):
        kind = r.random()
        if out and kind < 0.2:
            own = list(r.choice(out))
        elif out and kind < 0.5:
            own = list(r.choice(out))
            for _ in range(r.randint(1, 6)):
                if own:
                    own[r.randrange(len(own))] = word()
        else:
            own = [word() for _ in range(r.choice([0, 2, 4, 5, 49, 50, 120, 300]))]
        if r.random() < 0.2:
            at = r.randint(0, len(own))
            own[at:at] = passage[: r.randint(40, 70)]
        out.append(own)
    return [(k * 3 + 1, " ".join(w)) for k, w in enumerate(out)]


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_is_brute_force(spark, seed):
    docs = corpus(seed)
    first = {}
    for k, text in docs:
        own = text.split()
        for i in range(len(own) - 49):
            first.setdefault(tuple(own[i : i + 50]), k)
    want = {}
    for k, text in docs:
        own = text.split()
        gone = {j for i in range(len(own) - 49) if first[tuple(own[i : i + 50])] < k for j in range(i, i + 50)}
        want[k] = (len(own), len(gone), " ".join(w for j, w in enumerate(own) if j not in gone))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.deduplicate(df).collect()}
    assert got == want
    assert sum(v[1] > 0 for v in want.values()) > 10


@pytest.mark.parametrize("seed", [3, 4])
def test_jaccard_is_brute_force(spark, seed):
    docs = corpus(seed)
    sets = {}
    for k, text in docs:
        own = text.lower().split()
        sets[k] = {tuple(own[i : i + 5]) for i in range(len(own) - 4)} or ({tuple(own)} if own else set())
    root = {k: k for k, _ in docs}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    links = 0
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                links += 1
                x, y = sorted((top(a), top(b)))
                root[y] = x
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.group(df).collect()}
    assert got == {k: (len(sets[k]), top(k)) for k in sets}
    assert links > 20


def test_jaccard_at_other_thresholds(spark, monkeypatch):
    """The filter follows the threshold; sets with too few segments go another way."""
    def miss(p, k):
        return sum(math.comb(jaccard.MINIMA, i) * p**i * (1 - p) ** (jaccard.MINIMA - i) for i in range(k))

    assert jaccard.least_shared(75) == 6
    for percent in range(51, 101):
        least = jaccard.least_shared(percent)
        assert miss(percent / 100, least) <= jaccard.MISS
        assert least == jaccard.MINIMA or miss(percent / 100, least + 1) > jaccard.MISS
    none = spark.createDataFrame([(k, [10 * k, 10 * k + 1]) for k in range(3)], "id long, minima array<long>")
    assert {r.id for r in jaccard.suspects(none, 54).collect()} == {0, 1, 2}
    assert {r.id for r in jaccard.suspects(none, 55).collect()} == set()
    # 60 shingles each, 42 of them shared: a similarity of 42 in 78, 0.538.
    docs = [(2 * k + j, " ".join(f"w{k}x{i}" for i in range(46)) + " " + " ".join(f"v{k}x{i}y{j}" for i in range(18))) for k in range(40) for j in range(2)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard.group(df, percent=53).collect()} == {k: k // 2 * 2 for k, _ in docs}
    assert {r.doc_id: r.component_id for r in jaccard.group(df, percent=54).collect()} == {k: k for k, _ in docs}
    for percent in (50, 0, 101, 75.5):
        with pytest.raises(ValueError, match="51 to 100"):
            jaccard.group(df, percent=percent)
    sets = spark.createDataFrame([(1, np.arange(100, dtype=np.uint64).tobytes())], "id long, shingles binary")
    plan, lacking = jaccard.allocation(sets, 75)
    assert set(plan) == {6} and not lacking
    monkeypatch.setattr(jaccard, "FACTORS", (0.3,))
    assert jaccard.allocation(sets, 75)[1]


def test_jaccard_exact_ways(spark, monkeypatch):
    """Nothing left out before the index, or every set short of segments: the same groups."""
    r = random.Random(8)
    docs = []
    for k in range(60):
        tokens = [f"w{k}x{i}" for i in range(r.choice([5, 6, 9, 11, 30, 70]))]
        docs.append((3 * k, " ".join(tokens)))
        docs.append((3 * k + 1, " ".join([*tokens, f"end{k}"])))
        docs.append((3 * k + 2, " ".join(["start", *tokens[1:]])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    groups = lambda **options: {r.doc_id: r.component_id for r in jaccard.group(df, **options).collect()}
    shingles = {k: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for k, t in docs}
    want = {k: k for k, _ in docs}
    for k in range(0, 180, 3):
        for a, b in ((k, k + 1), (k, k + 2), (k + 1, k + 2), (k, k + 1), (k, k + 2)):
            if 100 * len(shingles[a] & shingles[b]) >= 75 * len(shingles[a] | shingles[b]):
                want[a] = want[b] = min(want[a], want[b])
    assert jaccard.least_shared(75, 0) == 0
    assert groups() == groups(miss=0) == want
    monkeypatch.setattr(jaccard, "FACTORS", (0.3,))
    assert groups() == want


def test_segments_find_every_similar_pair(spark, monkeypatch):
    """Pairs exactly at the limit, of all sizes, with few segments and left-out shingles."""
    r = np.random.default_rng(0)
    rows, want = [], set()
    for k, n in enumerate([1, 2, 3, 4, 7, 8, 15, 16, 30, 63, 64, 100, 127, 128, 255, 300, 511, 900]):
        base = np.unique(r.integers(0, 2**63, 2 * n, dtype=np.uint64))[:n]
        other = base[: max(1, -(-3 * n // 4))]
        for j, s in enumerate((base, other)):
            rows.append((2 * k + j, len(s), 0, np.sort(s).tobytes()))
        if 100 * len(other) >= 75 * len(base) and n > 1:
            want.add((2 * k, 2 * k + 1))
    sets = spark.createDataFrame(rows, "id long, n long, u long, shingles binary")
    for factors in ((1.0,), jaccard.FACTORS):
        monkeypatch.setattr(jaccard, "FACTORS", (*factors, 16.0))
        got = {tuple(sorted(p)) for p in jaccard.similar(sets, 75).collect()}
        assert want <= got


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1200)] + [(5000, k) for k in range(4000, 4500)]
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((top(a), top(b)))
            root[y] = x
    got = {q.node: q.component for q in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: top(k) for k in root}


def test_vectors_recall_and_counts(spark):
    r = np.random.default_rng(2)
    base = r.standard_normal((300, 24))
    near = base[:100] + r.standard_normal((100, 24)) * r.uniform(0.05, 0.5, (100, 1))
    x = np.concatenate([base, near, base[:20], base[:20]]).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    true = u @ u.T >= 0.9
    np.fill_diagonal(true, False)
    got = {q.vec_id: q.n_links for q in vectors.near_duplicates(df).collect()}
    assert all(got[k] <= true[k].sum() for k in got)
    assert sum(got.values()) >= 0.9 * true.sum() > 0


def test_vectors_tiles_count_the_same(spark, monkeypatch):
    r = np.random.default_rng(3)
    x = (np.ones(8) + r.standard_normal((90, 8)) * 0.02).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    monkeypatch.setattr(vectors, "TILE", 16)
    assert {(q.n_links, q.component_id) for q in vectors.near_duplicates(df).collect()} == {(89, 0)}


def test_recall_is_planned():
    for n in (10, 10**5, 10**7):
        depth, tables = vectors.parameters(n, 0.9)
        p = vectors.collision(np.sqrt(0.2)) ** depth
        assert 1 - (1 - p) ** tables >= vectors.RECALL


def test_encoding_is_the_library(spark):
    r = random.Random(1)
    letters = "aeiouxyz'sthng ÉéΣσßİ1２३.,!?<|>\n\t  中文字кирé́👍🏽​ "
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 80))) for _ in range(3000)]
    texts += ["<|startoftext|> A <|endoftext|>b", "a" * 5000, "ab" * 3000, "it's I'LL", "", "y" * 33]
    texts += [t for (t,) in duckdb.sql(f"SELECT text FROM '{SMALL}/documents.parquet'").fetchall()]
    library, spec = Tokenizer.from_file(PATH), bpe.vocabulary(PATH)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    coded = bpe.encode(df, spec)
    assert {q.doc_id: (q.n_tokens, q.ids) for q in coded.collect()} == {k: (len(w), w) for k, w in enumerate(want)}
    decoded = [library.decode(w, skip_special_tokens=False) for w in want]
    assert {q.doc_id: q.decoded for q in bpe.decode(coded, spec).collect()} == dict(enumerate(decoded))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert {tuple(q) for q in bpe.round_trip(df, spec).collect()} == {
        (k, len(w), sha(" ".join(map(str, w))), sha(d)) for k, (w, d) in enumerate(zip(want, decoded))
    }


def test_compatible_pairs_are_merges():
    encoder = bpe.Encoder(bpe.vocabulary(PATH))
    r = random.Random(3)
    for _ in range(3000):
        word = "".join(r.choice("etaoinshrdlu") for _ in range(r.randint(1, 12)))
        greedy, merged = encoder.greedy(word), encoder.merged(word)
        pairs = np.array(list(zip(greedy, greedy[1:])), dtype=np.int64).reshape(-1, 2)
        assert (greedy == merged) == bool(encoder.compatible(pairs[:, 0], pairs[:, 1]).all())
    encoder = bpe.Encoder(bpe.vocabulary(PATH))
    long = "etaoin" * 9
    short = encoder.merged(long)
    assert short == Tokenizer.from_file(PATH).encode(long, add_special_tokens=False).ids


def test_used_strings_come_back_from_the_older_half(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_STRINGS", 8)
    encoder, learned = bpe.Encoder(bpe.vocabulary(PATH)), []
    monkeypatch.setattr(encoder, "learn", lambda new, learn=encoder.learn: learned.extend(new) or learn(new))
    for k in range(6):
        encoder.prepare_strings([["the", "cat", *(f"w{k}{c}" for c in "abcde"), "x" * 99]])
        assert encoder.known_ids["x" * 99] and encoder.known_text["cat"] == "cat</w>"
        encoder.forget_long()
        assert len(encoder.known_ids) + len(encoder.older_ids) <= 8 + 7
    assert learned.count("the") == learned.count("cat") == 1 and learned.count("x" * 99) == 6


def test_both_splitters_give_the_same_words():
    encoder, r = bpe.Encoder(bpe.vocabulary(PATH)), random.Random(4)
    low = [chr(c) for c in range(0x530)]
    for text in ["".join(low), *("".join(r.choices([*low, *" '", *"'std lmrev" * 20], k=300)) for _ in range(300))]:
        assert encoder.high.search(text) is None
        assert encoder.low_splitter.findall(text) == encoder.splitter.findall(text)
    assert encoder.high.search("a\u0530") and encoder.split("a\u20001 中x") == ["a", "1", "中x"]


def test_viterbi_is_brute_force():
    r = np.random.default_rng(0)
    for _ in range(40):
        offsets = np.concatenate([[0], np.cumsum(r.integers(0, 300, 4))])
        scores, want = r.normal(size=(offsets[-1], 3)) * 3, []
        for a, b in zip(offsets[:-1], offsets[1:]):
            best, back = scores[a].copy() if b > a else None, []
            for t in range(a + 1, b):
                j = best.argmax()
                back.append(np.where(best >= best[j] - 5, np.arange(3), j))
                best = np.maximum(best, best[j] - 5) + scores[t]
            path = [best.argmax()] if b > a else []
            for c in back[::-1]:
                path.append(c[path[-1]])
            want += path[::-1]
        assert (language.viterbi(scores, offsets, 5.0) == np.array(want)).all()


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = queries.op5_language_id(spark, "/root/testdata/sf0.01").where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    right = sum(r.lang == r.lang_pred for r in found)
    assert right >= 0.97 * len(found) and len(found) > 200
    assert all(0 <= r.score <= 1 for r in found)


def test_mixed_text_is_labelled_in_spans(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs)
    pick = {r.lang: " ".join(r.text.split()[:60]) for r in docs.where("lang in ('de', 'es') and n_chars between 500 and 3000 and doc_id > 500").collect()}
    text = pick["de"] + " " + pick["es"]
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = language.spans(df, model).orderBy("start").collect()
    assert [r.lang for r in got] == ["de", "es"]
    assert abs(got[1].start - len(pick["de"]) - 1) < 40 and got[-1].end <= len(text)


def base_spans(text):
    def luhn(digits):
        doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
        return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0

    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    }
    return [(k, m.start(), m.end()) for k, (p, ok) in rules.items() for m in re.finditer(p, text) if ok(m[0])]


def test_base_spans_are_brute_force(spark):
    r = random.Random(9)
    texts = ["".join(r.choice("a@.b-1 25+()é_%\n😀4") for _ in range(r.randint(0, 60))) for _ in range(4000)]
    texts += ["a@b.cc_x@y.zz", "1.2.3.4.5 256.1.1.1 01.002.0255.3", "4111 1111 1111 1111", "4111-1111-1111-11112", "+1 (269) 555-3296.", "4111111111111111 5500005555555559 +4912345678 x@y.z"]
    texts += ["".join(r.choice("4 1-") for _ in range(r.randint(15, 45))) for _ in range(2000)]
    texts += ["a@" + "b." * 20_000 + "c", "x." * 50_000 + "@", "1." * 50_000 + "1", "9" * 100_000, "+" + "1(" * 20_000]
    texts += [t for (t,) in duckdb.sql(f"SELECT text FROM '{SMALL}/documents.parquet'").fetchall()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for row in pii.find(df).collect():
        got = [tuple(s) for s in row.spans if s.kind != "secret"]
        assert got == base_spans(texts[row.doc_id]), texts[row.doc_id][:200]


def test_secrets_are_added(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    planted = r"AKIA[0-9A-Z]{16}|(?<=password=)[0-9a-f]+|(?<=token = \")[0-9a-f]+"
    hit = total = extra = 0
    for row in pii.find(docs).join(docs.select("doc_id", "text"), "doc_id").collect():
        want = {(m.start(), m.end()) for m in re.finditer(planted, row.text)}
        got = {(s.start, s.end) for s in row.spans if s.kind == "secret"}
        hit, total, extra = hit + len(want & got), total + len(want), extra + len(got - want)
    assert total > 10 and hit >= 0.9 * total and extra <= 0.1 * total


def test_reliabilities_find_the_good_voters():
    r = random.Random(4)
    seen = collections.Counter()
    for _ in range(4000):
        truth = r.random() < 0.4
        seen[tuple(int(truth if r.random() < p else not truth) for p in (0.95, 0.9, 0.6))] += 1
    post, rates, share = pii.reliabilities(sorted(seen.items()))
    assert abs(share - 0.4) < 0.05 and rates[0][0] > 0.9 > rates[2][0]
    assert post[(1, 1, 0)] > 0.9 > 0.1 > post[(0, 0, 1)]


def test_quality_of_rows_not_trained_on(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    part = F.pmod(F.xxhash64(F.lit(77), "doc_id"), F.lit(3)) == 0
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    model = quality.fit(docs, labels.where(~part), good, rows=4000)
    test = labels.where(part).limit(900)
    columns = quality.score(docs.limit(1), model).columns
    assert columns == ["doc_id", "text_score", "meta_score", "quality"]
    both = quality.score(docs.join(F.broadcast(test.select("doc_id")), "doc_id"), model).withColumnRenamed("quality", "s").join(test.withColumn("good", good), "doc_id").collect()
    right = sum((r.s >= 0.5) == r.good for r in both)
    clean = [r for r in both if r.good]
    assert right >= 0.93 * len(both) and sum(r.s >= 0.5 for r in clean) >= 0.98 * len(clean)


def test_lines_generalise_fields(spark):
    docs = [(k, f"own words of document number {w}\nnew login by user {w} from host {k}.example at noon\nshort\ntail {w} {w} {w}") for k, w in enumerate("anna bob carl dora emil".split())]
    got = {r.doc_id: r for r in lines.drop_recurring(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[0].text == docs[0][1] and got[0].n_dropped == 0
    assert got[3].text == "tail dora dora dora" and (got[3].n_lines, got[3].n_dropped) == (4, 3)
    two = [(1, "a line that two texts have"), (2, "a line that two texts have")]
    assert {r.n_dropped for r in lines.drop_recurring(spark.createDataFrame(two, "doc_id long, text string")).collect()} == {0}


def test_decontamination_sees_through_signs(spark):
    item = "Which of the following rivers flows through the city of Vienna and reaches the Black Sea"
    body = " ".join(f"filler{k}" for k in range(3000))
    docs = [(1, body + " " + item.upper().replace(" ", ",\n") + " " + body), (2, body), (3, item.replace("Vienna", "Bonn")), (4, " ".join(item.split()[:9])), (5, item)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r.doc_id: (r.n_item, r.n_shared) for r in decontaminate.contained(df, items, share=0.75).collect()}
    assert got == {1: (12, 12), 5: (12, 12)}
    low = {r.doc_id for r in decontaminate.contained(df, items, share=0.4).collect()}
    assert low == {1, 3, 4, 5}


def test_shards_hold_the_mixture(spark):
    docs = spark.createDataFrame([(k, "big" if k % 3 else f"s{k % 7}") for k in range(5000)], "doc_id long, source string").repartition(7)
    rows = sharding.interleave(docs, 16).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    sizes = [len(v) for v in by.values()]
    assert max(sizes) - min(sizes) <= 1 and len(by) == 16
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by.values())
    for source in {r.source for r in rows}:
        counts = [sum(r.source == source for r in v) for v in by.values()]
        assert max(counts) - min(counts) <= 4
    again = {(r.doc_id, r.shard, r.slot) for r in sharding.interleave(docs.repartition(3), 16).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in rows}


def test_shards_are_written_in_order(spark, tmp_path):
    docs = spark.createDataFrame([(k, "s", f"t{k}") for k in range(100)], "doc_id long, source string, text string")
    sharding.write(sharding.interleave(docs, 4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out" / "shard=2")).collect()
    assert [r.slot for r in back] == list(range(25))


def test_words_of_blocks_and_pieces(monkeypatch):
    import pyarrow as pa

    texts = pa.array(["ab  cd\tAB", None, "", "x" * 100, "ab é\x0bcd"])
    hashes, offsets = words.word_hashes(texts)
    assert offsets.tolist() == [0, 3, 3, 3, 4, 7] and hashes[0] == hashes[4] and hashes[1] == hashes[6]
    lower, _ = words.word_hashes(texts, lower=True)
    assert lower[0] == lower[2] and hashes[0] != hashes[2]
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    assert [p.num_rows for p in words.pieces(batch, "text", 10)] == [3, 1, 1]
    assert sum(len(words.word_hashes(p.column("text"))[0]) for p in words.pieces(batch, "text", 10)) == 7
    monkeypatch.setattr(words, "BLOCK_BYTES", 16)
    monkeypatch.setattr(words, "_TABLES", {})
    again, _ = words.word_hashes(texts)
    assert again[0] == again[4] and len(again) == 7


def test_jaccard_hands_few_rows_to_python_at_a_time(spark, monkeypatch):
    """Batches of 10,000 texts or sets took an executor of 3,000 MB over its memory."""
    name, seen, store = "spark.sql.execution.arrow.maxRecordsPerBatch", [], jaccard.stored
    before = spark.conf.get(name)
    monkeypatch.setattr(jaccard, "stored", lambda df: seen.append(int(spark.conf.get(name))) or store(df))
    df = spark.createDataFrame([(k, f"a b c d e f {k // 2} g h") for k in range(20)], "doc_id long, text string")
    assert {r.component_id for r in jaccard.group(df).collect()} == set(range(0, 20, 2))
    assert seen and max(seen) <= jaccard.BATCH_ROWS and spark.conf.get(name) == before
