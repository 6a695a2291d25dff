"""The queries of the training-data operators against SQL, brute force or an exact round trip, on the smallest tables."""

import binascii
import hashlib
import re
from collections import Counter, defaultdict

import pytest

from gristmill.llm import queries

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark, sf):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(name, spark, sf, duck, canon):
    got, want = queries.QUERIES[name](spark, sf).toPandas(), duck(sf, queries.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert canon(got) == canon(want)


def test_op1(spark, sf, docs):
    rows = queries.QUERIES["op1_histogram_sharding"](spark, sf).collect()
    assert len(rows) == len(docs) and {r.law for r in rows} == {"bytes"}
    by = defaultdict(list)
    for r in rows:
        data = docs[r.doc_id].text.encode()
        assert r.size == len(data) + 1 and r.text_crc32 == binascii.crc32(data) and r.grown_shard is None
        by[r.shard].append(r)
    assert set(by) <= set(range(16))
    assert all(sorted(r.slot for r in rs) == list(range(len(rs))) for rs in by.values())
    sizes, largest = [sum(r.size for r in rs) for rs in by.values()], max(r.size for r in rows)
    assert max(sizes) - min(sizes) <= 2 * largest


def test_op3(spark, sf, docs):
    for r in queries.QUERIES["op3_license_scan"](spark, sf).collect():
        words = ALNUM.findall(docs[r.doc_id].text.translate(LOW))
        places, labels = [], set()
        for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
            p = phrase.split()
            found = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            places += found
            labels |= {label} if found else set()
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((min(places), max(places)) if places else (None, None))
        assert r.base_labels == ",".join(sorted(labels)) and labels <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1


def test_op4(spark, sf, docs):
    for r in queries.QUERIES["op4_mpeg_audio"](spark, sf).collect():
        data = docs[r.doc_id].text.encode()
        payload = data + bytes(-len(data) % 64 or (0 if data else 64))
        assert (r.n_bytes, r.payload_bytes) == (len(data), len(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == binascii.crc32(payload[-64:]) and "crc_bad=0" in r.feature


def brute_components(texts, width, num, den):
    sets = {}
    for i, t in texts.items():
        w = SPACED.findall((t or "").translate(LOW))
        sets[i] = frozenset(tuple(w[j : j + width]) for j in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    post = defaultdict(list)
    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in post[x]).items():
            if den * n >= num * (len(s) + len(sets[j]) - n):
                a, b = sorted((top(i), top(j)))
                up[b] = a
        for x in s:
            post[x].append(i)
    return {i: (len(s), top(i)) for i, s in sets.items()}


def test_op6(spark, sf, docs):
    want = brute_components({i: r.text for i, r in docs.items()}, 4, 85, 100)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in queries.QUERIES["op6_ngram_jaccard_join"](spark, sf).collect()} == want


def test_op7(spark, sf, docs):
    rows = queries.QUERIES["op7_source_mixing"](spark, sf).collect()
    assert {(r.doc_id, r.size) for r in rows} == {(i, len(SPACED.findall(d.text))) for i, d in docs.items()}
    got, sizes, targets = Counter(), Counter(), {}
    for r in rows:
        s = docs[r.doc_id].source
        got[s] += r.taken
        sizes[s] += r.size
        targets[s] = r.target
        assert 0 <= r.taken <= 2 * r.size
    assert all(abs(got[s] - t) <= 1 for s, t in targets.items()) and all(t <= 2 * sizes[s] + 1e-6 for s, t in targets.items())
    assert abs(sum(targets.values()) - 1.5 * sum(sizes.values())) < 1
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(targets))}
    free = {round(t / weight[s], 6) for s, t in targets.items() if t < 2 * sizes[s] - 1e-6}
    assert len(free) <= 1
    assert sorted(rows) == sorted(queries.QUERIES["op7_source_mixing"](spark, sf).collect())


def brute_pii(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 12 <= len(d) <= 19 and (sum(d[::2]) + sum(sum(divmod(2 * c, 10)) for c in d[1::2])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def test_op8(spark, sf, docs):
    kinds = ("email", "ip", "card", "phone")
    for r in queries.QUERIES["op8_pii"](spark, sf).collect():
        base = brute_pii(docs[r.doc_id].text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in base) for n in range(4)]
        spans = [f"{kinds[k]}:{b}:{e}" for b, k, e in base]
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest() and set(spans) <= set(r.spans.split(","))


def test_op2_and_op5_held_out(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES["op2_toxicity"](spark, folder).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in rows) / len(rows) >= 0.94 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in queries.QUERIES["op5_language_id"](spark, folder).collect() if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in rows) / len(rows) >= 0.97
    assert all(r.held_out == (binascii.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
