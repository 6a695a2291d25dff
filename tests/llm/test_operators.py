"""Parts of the training-data operators on hand-made cases."""

import random
import struct
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.llm import common, decontaminate, language_id, licenses, mixing, mpeg_audio, ngram_join, pii, sharding, toxicity, url_filter


def test_sharding_hot_rows(spark):
    rows = spark.createDataFrame([(1, "same " * 20)] * 700 + [(i, f"text {i}") for i in range(300)] + [(None, None), (None, "")], "doc_id long, text string")
    got = sharding.histogram_shard(rows, 8).groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.max("slot").alias("top")).collect()
    assert len(got) == 8 and max(r.b for r in got) - min(r.b for r in got) <= 2 * 101 and all(r.top == r.n - 1 for r in got)


def share_out(sizes, weights, share, most):
    """Targets by weight, none above `most` times its size; what is over goes to the others by weight, until none is above."""
    left, out, open_ = share * sum(sizes), [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s]
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * unit > most * sizes[i]]
        for i in full or open_:
            out[i] = most * sizes[i] if full else weights[i] * unit
            left -= out[i] if full else 0
        open_ = [i for i in open_ if i not in full] if full else []
    return out


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    names = sorted({rng.choice(("", "é", "Z", "a", "aa", "\U0001f642", "\uffff")) + str(i) for i in range(rng.choice((1, 2, 30)))}, key=str.encode) + [None]
    sizes = [rng.choice((0, 1, 10, 500, 100_000)) for _ in names]
    got = mixing.source_targets(spark.createDataFrame(rng.sample(list(zip(names, sizes, strict=True)), len(names)), "source string, source_size long")).orderBy("source_no").collect()
    assert [r.source for r in got] == names and [r.source_no for r in got] == list(range(len(names)))
    assert [r.target for r in got] == pytest.approx(share_out(sizes, [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5, 2.0))


def test_mixing_many_sources(spark):
    docs = spark.range(9000).selectExpr("id as doc_id", "concat('w ', id) as text", "cast(id % 4000 as string) as source")
    streams, targets, slots = mixing.mix(mixing.sized_documents(docs))
    rows = mixing.words_taken(streams, slots).groupBy("source").agg(F.sum("taken").alias("taken"), F.max(F.expr("taken - 2 * size")).alias("over")).collect()
    want = {r.source: r.goal for r in targets.collect()}
    assert len(want) == 4000 and all(r.taken == want[r.source] and r.over <= 0 for r in rows)


def test_mixing_alike_rows(spark):
    """Rows that are alike in everything are a hot key of nothing: they are laid out as one."""
    docs = spark.createDataFrame([(1, "a b c", "s")] * 500 + [(i, "d e", "t") for i in range(2, 200)] + [(None, None, None)] * 300, "doc_id long, text string, source string")
    streams, targets, slots = mixing.mix(mixing.sized_documents(docs), block=16)
    rows = mixing.words_taken(streams, slots, 16).collect()
    assert len(rows) == 998 and sum(r.taken for r in rows) == sum(r.goal for r in targets.collect())
    places = sorted((r.start, r["size"]) for r in rows if r.source == "s")
    assert [a for a, _ in places] == list(range(0, 1500, 3))


def test_mixing_many_small_blocks(spark):
    docs = spark.createDataFrame([(i, " ".join(["w"] * (i % 7)), "abc"[i % 3]) for i in range(200)] + [(900, "x y", None)], "doc_id long, text string, source string")
    streams, targets, slots = mixing.mix(mixing.sized_documents(docs), block=4)
    rows = mixing.words_taken(streams, slots, 4).collect()
    want = {r.source: r.goal for r in targets.collect()}
    got = {}
    for r in rows:
        got[r.source] = got.get(r.source, 0) + r.taken
        assert r.taken <= 2 * r["size"]
    assert got == want and len(rows) == 201


@pytest.mark.parametrize("small", [200_000, 0])
def test_phrases_and_proximity(spark, monkeypatch, small):
    """Both ways to join, that for few terms and that beyond."""
    monkeypatch.setattr(decontaminate, "SMALL_ROWS", small)
    docs = spark.createDataFrame([(1, "Aa bb, CC dd. Éé aa"), (2, "cc BB aa"), (3, None), (4, "éé aa bb cc")], "doc_id long, text string")
    items = spark.createDataFrame([("a", "aa bb cc"), ("b", "éé"), ("c", ""), ("d", None), ("e", "ÉÉ")], "item_id string, text string")
    hashes = {r.text_hash: r.doc_id for r in docs.select("doc_id", decontaminate.text_hash()).collect()}
    got = {hashes[r.text_hash]: (r.n_hit, r["items"], r.n_near) for r in decontaminate.contamination(docs, items).collect()}
    assert got == {1: (3, ["a"], 1), 2: (None, None, 1), 4: (4, ["a", "b"], 1)}


def test_phrases_at_random(spark):
    """Few different words put many near misses; runs must be those of all windows."""
    rng = random.Random(5)
    words = lambda n, k: [f"w{min(rng.randrange(k), rng.randrange(k))}" for _ in range(n)]
    items = {i: words(rng.choice((1, 2, 5, 12, 30)), 4) for i in range(25)}
    docs = {i: words(rng.choice((0, 3, 40, 200)), 4) + items[i % 25] + words(20, 4) for i in range(60)}
    got = decontaminate.contamination(*(spark.createDataFrame([(i, " ".join(w)) for i, w in x.items()], f"{k} long, text string") for x, k in ((docs, "doc_id"), (items, "item_id"))), width=6)
    rows = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string").select("doc_id", decontaminate.text_hash()).join(got, "text_hash", "left").collect()
    for r in rows:
        w, hit, own = docs[r.doc_id], set(), set()
        for i, item in items.items():
            n = min(6, len(item))
            windows = {tuple(item[j : j + n]) for j in range(len(item) - n + 1)}
            places = [j for j in range(len(w) - n + 1) if tuple(w[j : j + n]) in windows]
            own |= {str(i)} if places else set()
            hit.update(x for j in places for x in range(j, j + n))
        assert (r.n_hit or 0, r["items"] or []) == (len(hit), sorted(own))


def test_audio_resync_and_checksums():
    payload = bytes(range(256)) * 40
    stream = mpeg_audio.write_stream(payload, len(payload))
    clean = mpeg_audio.read_stream(stream)
    assert clean["payload"] == payload and clean["table_frames"] == len(clean["offsets"]) and clean["samples"] == 1152 * len(clean["offsets"]) and clean["skipped"] == 0
    at = clean["offsets"][3]
    junk = stream[:at] + b"\xff\xfbjunk bytes\xff" + stream[at:]
    found = mpeg_audio.read_stream(junk)
    assert found["payload"] == payload and found["skipped"] == 13 and len(found["offsets"]) == len(clean["offsets"])
    broken = bytearray(stream)
    broken[at + 4] ^= 1
    assert mpeg_audio.read_stream(bytes(broken))["crc_bad"] == 1
    assert mpeg_audio.read_stream(b"")["offsets"] == [] and mpeg_audio.read_stream(b"\xff" * 500)["offsets"] == []
    assert mpeg_audio.parse_header(bytes((0xFF, 0xFB, 0x90, 0x00)))[:3] == (417, 1152, 44100) and mpeg_audio.parse_header(bytes((0xFF, 0xFF, 0x90, 0x00)))[1] == 384


def test_licence_alignment():
    index = licenses.Index({b"the": 90, b"license": 20, b"apache": 3}, 100)
    words = licenses.words_of("x y Licensed under the Apache License, Version 2.0. MIT license; mit License General Public License")
    places, found = index.scan(words)
    assert [p for p, _ in places] == [5, 10, 12, 14] and found == [(2, "apache-2.0", 1.0)]
    assert index.scan(licenses.words_of("apache versions license")) == ([], [])
    for name, (text, _) in licenses.TEMPLATES.items():  # each template is found as itself, also among other words
        assert [n for _, n, _ in index.scan(licenses.words_of(f"xx {text} yy"))[1]] == [name]
    for text, name in (("GNU Lesser General Public License, version 3", "lgpl-3.0"), ("GNU Library General Public License version 2", "lgpl-2.0"), ("the GNU Affero General Public License version 3", "agpl-3.0"), ("Licensed under CC BY-NC 4.0.", "cc-by-nc-4.0")):
        assert [n for _, n, _ in index.scan(licenses.words_of(text))[1]] == [name]


def test_licences_by_all_places(spark, sf):
    """What the index finds is what a look at every template at every place finds."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = [r.text for r in docs.collect()]
    rng = random.Random(1)
    pick = list(licenses.TEMPLATES.values())
    texts += [" ".join(w if rng.random() < 0.95 else "zz" for t in rng.sample(pick, 2) for w in ("aa", *t[0].split(), "bb")) for _ in range(60)]
    counts, n = licenses.document_counts(spark.createDataFrame([(x,) for x in texts], "text string"), licenses.licence_words())
    index = licenses.Index(counts, n)
    found = 0
    for text in texts:
        words = licenses.words_of(text)
        there = [(name, i, c) for name, t in index.templates.items() for i in range(-len(t), len(words)) if (c := index.coverage(name, i, words))]
        got = index.scan(words)[1]
        assert got == licenses.longest(there, index.templates)
        found += len(got)
    assert found > 50


def test_toxic_folding():
    weights = {"w:idiot": 4.0, "w:trash": 4.0, "s:lowe": 4.0}
    lexicon = toxicity.automaton(weights)
    hits = lambda t: toxicity.score_text(t, lexicon)[1]
    assert [hits(t) for t in ("an IDIOT!", "1d10t", "idi0ts", "іdiоt", "stupid***", "the trash can is full", "trash", "loweish", "flower", "id\u200biot", "2024 10$", "")] == [1, 1, 0, 1, 0, 0, 1, 1, 0, 1, 0, 0]
    assert toxicity.score_text("idiot", lexicon)[0] > toxicity.score_text("idiot " + "word " * 20000, lexicon)[0]
    assert toxicity.score_text(None, lexicon) == (0.0, 0)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "you idiot, you worthless moron"), (2, "fine")], "doc_id long, text string")
    weights = toxicity.learn_weights(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.mark_toxic(docs, weights).count() == 1


def test_forward_backward_is_exact():
    rng = np.random.default_rng(0)
    lengths = np.array([1, 5, 64, 65, 200])
    e, t = rng.normal(size=(lengths.sum(), 3)).astype(np.float32), rng.normal(size=(3, 3)).astype(np.float32)
    got, at = language_id.forward_backward(e, lengths, t), 0
    for n in lengths:
        x, m = np.exp(e[at : at + n].astype(float)), np.exp(t.astype(float))
        a, b, v = np.zeros((n, 3)), np.zeros((n, 3)), np.ones(3)
        for i in range(n):
            v = v @ m * x[i]
            a[i] = v = v / v.sum()
        v = np.ones(3)
        for i in range(n - 1, -1, -1):
            b[i] = v
            v = m @ (x[i] * v)
            v = v / v.sum()
        want = a * b / (a * b).sum(1, keepdims=True)
        assert np.abs(want - got[at : at + n]).max() < 1e-4
        at += n


def test_code_switching(spark):
    rng = random.Random(1)
    word = {"aa": lambda: "".join(rng.choice("kbt") + rng.choice("ao") for _ in range(3)), "bb": lambda: "".join(rng.choice("szv") + rng.choice("ei") for _ in range(3))}
    field = language_id.fit_field([(lang, [make() for _ in range(12)]) for lang, make in word.items() for _ in range(60)])
    text = " ".join([word["aa"]() for _ in range(30)] + [word["bb"]() for _ in range(20)])
    rows = language_id.identify_language(spark.createDataFrame([(1, text, True), (2, None, False), (3, "12 !", False)], "doc_id long, text string, held_out boolean"), field).collect()
    assert [(r.lang_pred, r.n_switches) for r in sorted(rows, key=lambda r: r.doc_id)] == [("aa", 1), ("und", 0), ("und", 0)]


@pytest.mark.parametrize(("width", "num", "den"), [(1, 85, 100), (2, 80, 100)])
def test_join_random_sets(spark, width, num, den):
    """Small vocabularies and light edits put many pairs at the border; components must be those of all pairs."""
    from tests.llm.test_queries import brute_components

    rng, texts = random.Random(width), {}
    for i in range(120):
        base = [f"w{rng.randrange(60)}" for _ in range(rng.choice((0, 1, 3, 7, 20, 90)))] if i % 4 == 0 or not texts[i - 1] else texts[i - 1].split()
        for _ in range(rng.randrange(3)):
            if base:
                base[rng.randrange(len(base))] = f"w{rng.randrange(60)}"
        texts[i] = " ".join(base)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link_components(rows, width, num, den).collect()}
    assert got == brute_components(texts, width, num, den)


def test_keys_meet():
    """Two sets at the limit always share a key."""
    rng = np.random.default_rng(3)
    for n in (1, 2, 6, 7, 15, 16, 31, 60, 130, 500):
        for _ in range(20):
            a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            apart = ngram_join.most_apart(n, 80, 100)
            b = np.unique(np.concatenate((a[apart // 2 :], rng.integers(0, 2**64, apart - apart // 2, dtype=np.uint64))))
            same = len(np.intersect1d(a, b))
            if 100 * same >= 80 * (len(a) + len(b) - same):
                assert set(ngram_join.keys_of(a, 80, 100)) & set(ngram_join.keys_of(b, 80, 100))


def test_filter_holds_all(spark):
    df = spark.range(5000)
    joined, bit = common.maybe_in(df, "id", spark.range(0, 5000, 7))
    got = {r.id for r in joined.where(bit).select("id").collect()}
    assert set(range(0, 5000, 7)) <= got and len(got) < 1000
    assert [common.filter_bits(n) for n in (0, 1 << 16, 1 << 40)] == [16, 21, 28]  # sized by the number of keys, up to the bound


def test_scratch_of_threads(spark):
    """Tables kept by one thread are no business of another's scratch; those of an inner one last as told."""
    import threading

    kept, ready, done = {}, threading.Event(), threading.Event()

    def other():
        kept["other"] = common.keep(spark.range(3))
        ready.set()
        done.wait(60)

    with common.scratch(spark) as paths:
        worker = threading.Thread(target=other)
        worker.start()
        ready.wait(60)
        with common.scratch(spark):
            kept["out"] = common.keep(spark.range(4), lasting=1)
        assert kept["out"].count() == 4 and len(paths) == 1
    done.set()
    worker.join()
    assert kept["other"].count() == 3
    with pytest.raises(Exception, match="(?i)exist|found"):
        kept["out"].count()


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="share"):
        common.shared_dir(Cluster)


def test_contextual_pii(spark):
    rows = [(i, f"reach me on phone +1 (212) 555-02{i:02d} now") for i in range(8)]
    rows += [(99, "zz reach me on phone 7-AB-99312 now"), (98, "room 7-AB-99312x is free"), (97, "call seven-oh-nine or 7-AB-99312 later"), (96, "reach me on phone seven-oh-nine now")]
    got = {r.doc_id: r for r in pii.extract_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[99].spans == "near_phone:21:31" and got[98].spans == "" and got[0].spans == "phone:18:35" and got[0].n_discovered == 0
    assert got[96].spans == "near_phone:18:31" and got[97].spans == "near_phone:5:18,near_phone:22:32"  # without a digit, and in other contexts
    assert pii.base_spans("x" * 50 + "@a.b a@b c@d.e.f@g.h") == [(0, 0, 54), (59, 0, 66)] and pii.base_spans("1.2.3.4444") == []


def test_pii_rounds(spark):
    """What is discovered makes further patterns known, round after round."""
    rows = [(i, f"ping host 10.0.0.{i} today") for i in range(20)]
    rows += [(40 + i, f"ping host node-{c} today and mount share node-{c} first") for i, c in enumerate("aaabbbcccddd")]
    rows += [(60, "please mount share vault-x first")]
    got = {r.doc_id: r.spans for r in pii.extract_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[40].startswith("near_ip:10:16,") and got[40].count("near_ip") == 2 and got[60] == "near_ip:19:26"


def test_pii_secrets(spark):
    rows = [(i, f'x token = "{i}f00d{i}abcdef0123" y') for i in range(5)] + [(9, 'z token = "correct-horse" w'), (8, "a token of thanks")]
    got = {r.doc_id: r.spans for r in pii.extract_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == "secret:11:27" and got[9] == "near_secret:11:24" and got[8] == ""


LONG = {"letters": "x" * 5_000_000, "signs": "!" * 5_000_000, "digits": "1" * 5_000_000, "dots": "1." * 2_500_000, "exceptions": "trash can " * 500_000, "cjk": "汉" * 1_700_000, "tokens": "token=" * 800_000, "licences": "public license version " * 220_000}


@pytest.mark.parametrize("kind", sorted(LONG))
def test_long_texts(kind):
    """In seconds, whatever they are made of."""
    text, began = LONG[kind], time.time()
    toxicity.score_text(text, toxicity.automaton({"w:trash": 4.0, "s:stup": 4.0}))
    pii.seed_instances(text, pii.base_spans(text)[:100], pii.WordHashes())
    pii.secrets(text)
    licenses.Index({}, 1).scan(licenses.words_of(text))
    assert mpeg_audio.read_stream(mpeg_audio.write_stream(mpeg_audio.padded(text), 1))["payload"].rstrip(b"\0").decode() == text
    assert len(ngram_join.shingle_set(text, 5, ngram_join.WordHashes())) > 0
    assert sum(len(r) for r in language_id.runs_of(text)) == len(language_id.WORD.findall(text.lower()))
    assert time.time() - began < 30


def test_a_border_between_alike_rows(spark):
    rows = spark.createDataFrame([(1, "same " * 20)] * 900 + [(2, "b")], "doc_id long, text string")
    got = sharding.histogram_shard(rows, 4).groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.max("slot").alias("top"), F.countDistinct("slot").alias("d")).collect()
    assert len(got) == 4 and max(r.b for r in got) - min(r.b for r in got) <= 2 * 101 and all(r.top == r.n - 1 == r.d - 1 for r in got)


def test_parts_of_shards(spark, monkeypatch):
    """Shards sorted in many parts, a third of the rows one text, are those that one sort gives; own columns of the helper's names stay."""
    rows = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot text', concat('text ', id * id)) as text", "id as size", "'x' as shard", "map(1, 2) as m")
    whole = {r.doc_id: (r.shard, r.slot) for r in sharding.histogram_shard(rows, 8).collect()}
    monkeypatch.setattr(sharding, "PART_BYTES", 2000)
    got = sharding.histogram_shard(rows, 8)
    assert got.columns == ["doc_id", "text", "own_size", "own_shard", "m", "size", "shard", "slot"] and got.rdd.getNumPartitions() > 60
    found = got.collect()
    assert all(r.own_size == r.doc_id and r.own_shard == "x" for r in found)
    by = {}
    for r in found:
        by.setdefault(r.shard, []).append((r.slot, r["size"]))
    assert all(sorted(s for s, _ in x) == list(range(len(x))) for x in by.values())
    assert {k: len(v) for k, v in by.items()} == {i: sum(s == i for s, _ in whole.values()) for i in range(8)}


def test_one_of_each_row(spark):
    same = "one two three four five six seven"
    rows = [(7, "a b c d e f"), (7, "u v w x y z"), (3, same), (3, same), (4, same), (None, same), (None, "q r s t u"), (None, "q r s t u"), (None, None), (None, None), (5, ""), (5, "")]
    got = sorted(((r.doc_id, r.text) for r in ngram_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(7, "a b c d e f"), (7, "u v w x y z"), (3, same), (None, "q r s t u"), (None, None), (None, None), (5, ""), (5, "")], key=str)


def test_join_templates(spark, monkeypatch):
    """Pages of one template, too far apart to link, meet block by block; a few real copies among them are found."""
    from tests.llm.test_queries import brute_components

    monkeypatch.setattr(ngram_join, "BLOCK", 20)
    monkeypatch.setattr(ngram_join, "HOT", 30)
    rng, texts = random.Random(2), {}
    for i in range(300):
        w = [f"w{j}" for j in range(60)]
        for _ in range(4):
            w[rng.randrange(60)] = f"x{i}"
        texts[i] = " ".join(w)
    for i in range(300, 320):
        texts[i] = texts[i - 300] + " tail"
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link_components(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 2, 85, 100).collect()}
    assert got == brute_components(texts, 2, 85, 100)


def test_transition_gradient():
    """The gradient by which transitions are learned against small steps of the likelihood."""
    rng, k, lengths = np.random.default_rng(1), 3, np.array([1, 4, 7])
    scores, t, gold = rng.normal(size=(12, k)), rng.normal(size=(k, k)), rng.integers(0, 3, 12)

    def loss(t):
        total, at, m = 0.0, 0, np.exp(t)
        for n in lengths:
            v = np.ones(k) / k
            for i in range(at, at + n):
                v = v @ m * np.exp(scores[i])
            total += np.log(v.sum()) - np.log(m[:, gold[at]].mean()) - scores[range(at, at + n), gold[at : at + n]].sum() - sum(t[gold[i - 1], gold[i]] for i in range(at + 1, at + n))
            at += n
        return total

    _, pairs = language_id.expected(language_id.potentials(scores), np.arange(12), lengths, np.exp(t - t.max()).astype(np.float32), gold)
    for a in range(k):
        for b in range(k):
            step = np.zeros((k, k))
            step[a, b] = 1e-4
            assert abs((loss(t + step) - loss(t - step)) / 2e-4 - pairs[a, b]) < 1e-4


def layer_frames(layer, bitrate, rate, mode, ext, n=4):
    """Frames with checksums over as many bits as a separate reading of the format says."""
    rng, out, covered = random.Random(layer), [], {(1, 0): 256, (1, 3): 128, (1, 1): (2 * 12 + 20) * 4}
    for _ in range(n):
        head = bytes((0xFF, 0xF8 | 4 - layer << 1, bitrate << 4 | rate << 2, mode << 6 | ext << 4))
        body = bytes(rng.randrange(256) for _ in range(mpeg_audio.parse_header(head)[0] - 6))
        bits = "".join(f"{x:08b}" for x in body)
        if layer == 1:
            n_bits = covered[1, mode]
        else:  # stereo at 48 kHz and 64 kbit/s a channel: 27 subbands of 4, 3 and 2 bits, then two more for each that is used
            widths, at, used = [4] * 11 + [3] * 12 + [2] * 4, 0, 0
            for width in widths:
                for _ in range(2):
                    used += "1" in bits[at : at + width]
                    at += width
            n_bits = at + 2 * used
        crc = 0xFFFF
        for c in "".join(f"{x:08b}" for x in head[2:]) + bits[:n_bits]:
            crc = (crc << 1 ^ (0x8005 if (crc >> 15) ^ int(c) else 0)) & 0xFFFF
        out.append(head + crc.to_bytes(2, "big") + body)
    return out


@pytest.mark.parametrize("kind", [(1, 14, 0, 0, 0), (1, 5, 1, 3, 0), (1, 5, 1, 1, 2), (2, 8, 1, 0, 0)])
def test_layer_checksums(kind):
    frames = layer_frames(*kind)
    got = mpeg_audio.read_stream(b"".join(frames))
    assert len(got["offsets"]) == 4 and got["crc_bad"] == got["skipped"] == 0
    frames[1] = frames[1][:7] + bytes((frames[1][7] ^ 0x40,)) + frames[1][8:]
    bad = mpeg_audio.read_stream(b"".join(frames))
    assert len(bad["offsets"]) == 3 and bad["crc_bad"] == 1 and bad["seconds"] == got["seconds"]


def test_frame_sizes():
    size = lambda *head: mpeg_audio.parse_header(bytes(head))[0]
    assert size(0xFF, 0xFF, 0xE0, 0) == 484 and size(0xFF, 0xFD, 0xA4, 0) == 576 and size(0xFF, 0xFB, 0x92, 0) == 418 and size(0xFF, 0xF3, 0x80, 0) == 208


def test_tags_tables_and_rates():
    payload = b"p" * 4000
    stream = mpeg_audio.write_stream(payload, 4000)
    frames = stream[mpeg_audio.read_tag(stream)[0] :]
    note = b"\x03payload_bytes\0" + b"4000"
    old = b"TXXX" + len(note).to_bytes(4, "big") + b"\0\0" + note + b"TXXX" + (300).to_bytes(4, "big") + b"\0\0" + b"\x03long\0" + b"v" * 294
    for tag in (b"ID3\x03\0\0" + mpeg_audio.syncsafe(len(old)) + old, b"ID3\x04\0\x10" + mpeg_audio.syncsafe(0) + b"3DI\x04\0\x10" + mpeg_audio.syncsafe(0), b"ID3\x02\0\0" + mpeg_audio.syncsafe(6 + len(note)) + b"TXX" + len(note).to_bytes(3, "big") + note):
        got = mpeg_audio.read_stream(tag + frames)
        assert got["skipped"] == 0 and got["payload"].startswith(payload) and (tag[3] == 4 or got["payload"] == payload)
    assert mpeg_audio.read_tag(b"ID3\x03\0\0" + mpeg_audio.syncsafe(len(old)) + old)[1]["long"] == "v" * 294
    seek = mpeg_audio.read_stream(stream)["table_seek"]
    assert len(seek) == 100 and seek == sorted(seek) and seek[0] > 0
    # VBRI: four entries of two bytes with a scale of 3
    head = bytes((0xFF, 0xFB, 0x90, 0xC4))
    vbri = head + bytes(32) + b"VBRI" + bytes(6) + struct.pack(">IIHHHH", 5000, 12, 4, 3, 2, 3) + struct.pack(">4H", 100, 110, 120, 130)
    sound = head + bytes(413)
    got = mpeg_audio.read_stream(vbri.ljust(417, b"\0") + sound * 3)
    assert (got["table_frames"], got["table_bytes"], got["table_seek"], len(got["offsets"])) == (12, 5000, [300, 630, 990, 1380], 3)
    # a second stream of another rate behind the first: seconds are those of each
    slow = bytes((0xFF, 0xFB, 0x98, 0xC4))
    both = mpeg_audio.read_stream(sound * 3 + (slow + bytes(572)) * 2)
    assert both["seconds"] == pytest.approx(3 * 1152 / 44100 + 2 * 1152 / 32000) and both["rates"] == {44100: 3456, 32000: 2304}


def test_url_rules():
    assert url_filter.split_url("HTTPS://Www.Example.COM/en/7?x#y") == ("www.example.com", "/en/7") and url_filter.split_url("mailto:x") == ("", "") and url_filter.split_url("a://b?c/d") == ("b", "")
    assert url_filter.fitting_rule("m.example.com", "/en/77") == ("example.com/en/7", "allow") and url_filter.fitting_rule("badexample.com", "/en/7") == ("com/en/", "block")
    a = url_filter.automaton_of(url_filter.VOCABULARY)
    assert url_filter.term_hits("http://casino-win.x/freebet", a) == {"casino": 4, "win": 1} and url_filter.term_hits("http://casinos1.x", a) == {}


def test_url_vocabulary_table(spark):
    terms = spark.createDataFrame([("Spam", 1), ("spam", 4), ("soft", 2), ("", 9), (None, 1), ("none", None)], "term string, weight int")
    own = url_filter.read_vocabulary(terms)
    assert own == {"spam": 4, "soft": 2}
    pages = spark.createDataFrame([(1, "http://a.b/spam"), (2, "http://a.b/soft/soft"), (3, "http://a.b/casino"), (4, "http://a.net/de/spam")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_filter.judge_urls(pages, vocabulary=own).collect()} == {1: "block", 2: "allow", 3: "allow", 4: "allow"}
    assert {r.verdict for r in url_filter.judge_urls(pages, vocabulary={}).collect()} == {"allow"}
