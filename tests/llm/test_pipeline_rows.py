"""Each stage of the pipeline on its own input, and the rows of the whole, against plain Python."""

import math
from collections import Counter, defaultdict

import corpus_pipeline
from gristmill.llm import mixing, toxicity
from gristmill.llm.common import keep, table

from .test_queries import ALNUM, LOW, SPACED, brute_components


def toxic(text, weights):
    """By a look at each word of the text on its own."""
    low, spans, best = toxicity.fold(text or ""), [], {}
    entries = [(k[0], k[2:], w) for k, w in weights.items()] + [("x", x, 0.0) for x in toxicity.EXCEPTIONS]
    exact = {t for kind, t, _ in entries if kind == "w"}
    by_head = defaultdict(list)
    for e in entries:
        by_head[e[1][0]].append(e)
    for i, c in enumerate(low):
        if i and low[i - 1].isalpha():
            continue
        for kind, term, w in by_head[c]:
            if low.startswith(term, i):
                closed = not low[i + len(term) : i + len(term) + 1].isalpha()
                if kind == "x" and closed:
                    spans.append((i, i + len(term)))
                elif kind == "w" and closed or kind == "s" and not (closed and term in exact):
                    best[i] = max(w, best.get(i, 0.0))
    total = sum(w for i, w in best.items() if not any(a <= i < b for a, b in spans))
    return total > 0 and 1 - math.exp(-total / (1 + math.log2(1 + len(text.split()) / toxicity.SCALE))) >= toxicity.BLOCK_AT


def windows(text, width=10):
    w = ALNUM.findall((text or "").translate(LOW))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def contaminated(text, items):
    w = ALNUM.findall((text or "").translate(LOW))
    return any(tuple(w[i : i + len(x)]) == x for n in {len(x) for x in items} for i in range(len(w) - n + 1) for x in [tuple(w[i : i + n])] if x in items)


def mixed_times(docs):
    """doc_id -> times, by counting the words that each slot takes one by one."""
    streams, _, slots = mixing.mix(keep(mixing.sized_documents(docs)))
    rows, taken = streams.collect(), defaultdict(Counter)
    for s in slots.collect():
        taken[s.source_no].update(range(s.low, s.high))
    for no in {r.source_no for r in rows}:  # streams have no gaps
        places = sorted((r.start, r.size) for r in rows if r.source_no == no)
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:], strict=False)) and places[0][0] == 0
    return {r.doc_id: math.floor(sum(taken[r.source_no][i] for i in range(r.start, r.start + r.size)) / r.size + 0.5) for r in rows if r.size}


def test_rows(spark, sf):
    docs = keep(table(spark, sf, "documents"))
    weights = toxicity.learn_weights(docs, table(spark, sf, "labels"))
    items = set().union(*(windows(r.text) for r in table(spark, sf, "benchmark").collect()))
    lost = Counter()
    for name, stage in corpus_pipeline.STAGES:
        rows = docs.collect()
        if name == "toxicity":
            want = Counter(r for r in rows if not toxic(r.text, weights))
        elif name == "ngram_jaccard_join":
            top = brute_components({r.doc_id: r.text for r in rows}, 5, 80, 100)
            want = Counter(r for r in rows if top[r.doc_id][1] == r.doc_id)
        elif name == "benchmark_decontamination":
            want = Counter(r for r in rows if not contaminated(r.text, items))
        elif name == "source_mixing":
            times = mixed_times(docs)
            want = +Counter({r: times.get(r.doc_id, 0) for r in rows})
            assert max(want.values()) == 2
        else:
            break
        docs = keep(stage(spark, docs, sf))
        got = docs.collect()
        assert Counter(got) == want, name
        lost[name] = len(rows) - len(got)
    assert all(lost[n] > 0 for n in ("toxicity", "ngram_jaccard_join", "benchmark_decontamination"))
    mixed = {r.doc_id: (r.text or "") for r in docs.collect()}
    out = corpus_pipeline.run(spark, sf).collect()
    assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in docs.collect())
    assert all(r.size == len(mixed[r.doc_id].encode()) + 1 for r in out)
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r)
    assert all(sorted(r.slot for r in rs) == list(range(len(rs))) for rs in by.values()) and set(by) <= set(range(16))
    sizes = [sum(r.size for r in by[i]) for i in range(16)]
    assert max(sizes) - min(sizes) <= 2 * 2 * max(r.size for r in out)  # equal texts stand together: at most two
