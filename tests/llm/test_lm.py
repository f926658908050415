import math
from collections import Counter

from pyspark.sql import functions as F

from skein.llm import suffix_tree
from tests.llm.test_dedup import words


def brute(rows, held, depth, p_min, penalty):
    """The same model with plain dictionaries."""
    seqs = {i: [*words(t), "END"] for i, t, *_ in rows}
    train = [s for i, s in seqs.items() if not held(i)]
    one = Counter(t for s in train for t in s)
    n, v = sum(one.values()), len(one)
    least = max(2, math.ceil(p_min * n))
    grams = {d: Counter(tuple(s[i : i + d + 1]) for s in train for i in range(len(s) - d)) for d in range(depth + 1)}
    base = lambda t: (one[t] + 0.1) / (n + 0.1 * (v + 1))
    states = {}

    def prob(context, t):
        if not context:
            return base(t)
        short = prob(context[1:], t)
        if context not in states:
            return short
        share, back = states[context]
        return share.get(t, 0) + back * short

    for d in range(1, depth + 1):
        count, made = grams[d - 1], {}
        for g, c in grams[d].items():
            if c >= least and count[g[:-1]] >= least:
                made.setdefault(g[:-1], {})[g[-1]] = c
        new = {}
        for s, kept in made.items():
            times = count[s]
            share = {t: (c - 0.75) / times for t, c in kept.items()}
            back = min(1, max(1e-6, 1 - sum(share.values())))
            gain = sum(c * math.log((share[t] + back * prob(s[1:], t)) / prob(s[1:], t)) for t, c in kept.items()) + (times - sum(kept.values())) * math.log(back)
            if gain > penalty * len(kept) * math.log(max(times, 2)):
                new[s] = (share, back)
        states.update(new)
    out = {}
    for i, s in seqs.items():
        score = sum(math.log10(prob(tuple(s[max(0, j - depth) : j]), t)) for j, t in enumerate(s))
        out[i] = (len(s), sum(one[t] > 0 for t in s), n, sum(math.log10(base(t)) for t in s), score)
    return out, states, prob, one


def test_scores(spark, docs, rows):
    frame = docs.withColumn("held_out", F.col("doc_id") % 7 == 0)
    want, states, prob, one = brute(rows, lambda i: i % 7 == 0, 2, 1e-4, 0.5)
    got = {r.doc_id: r for r in suffix_tree.score_texts(frame, p_min=1e-4).collect()}
    assert any(len(s) == 1 for s in states) and len(got) == len(want)
    for i, (n, known, total, base, score) in want.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, i % 7 == 0)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert math.isclose(r.score, score, rel_tol=5e-3, abs_tol=0.05)
    for s in list(states)[:5]:  # every state sums to one over the vocabulary and one unseen word
        assert math.isclose(sum(prob(s, t) for t in one) + prob(s, "never"), 1, rel_tol=1e-6)


def test_scores_odd(odd, nothing):
    assert suffix_tree.score_texts(odd.withColumn("held_out", F.lit(None).cast("boolean"))).count() == odd.count()
    assert suffix_tree.score_texts(nothing.withColumn("held_out", F.lit(True))).count() == 0
    alone = suffix_tree.score_texts(odd.withColumn("held_out", F.lit(True))).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in alone)


def test_rare_pairs_count_in_a_large_corpus(spark):
    """A pair that occurs twice bears on the scores, however many other words the corpus has."""
    rare = "quenby vostok"
    rows = [(i, " ".join("w%d" % (k * k % 997 + i) for k in range(20_000)), False) for i in range(30)]
    rows += [(i, rare, False) for i in range(1000, 1003)] + [(2000, rare, True)]
    got = {r.doc_id: r for r in suffix_tree.score_texts(spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")).collect()}
    assert got[2000].train_tokens * 5e-6 > 3
    assert got[2000].score > got[2000].base_score + 5
