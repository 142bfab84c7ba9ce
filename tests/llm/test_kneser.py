import math
import random
from collections import Counter, defaultdict

import pytest

from tidegate.llm import kneser

ORDER = 3


def clean(text):
    out = []
    for c in (text or "").lower():
        c = "0" if c in "0123456789" else " " if c in " \t\n\r\x0b\x0c\x85\xa0" else c
        if not (c == " " and (not out or out[-1] == " ")):
            out.append(c)
    if out and out[-1] == " ":
        out.pop()
    return "\x02" * (ORDER - 1) + "".join(out) + "\x03" if out else ""


class Naive:
    """The same model, n-gram by n-gram."""

    def __init__(self, texts):
        self.counts = {ORDER: Counter()}
        for text in map(clean, texts):
            self.counts[ORDER].update(text[i : i + ORDER] for i in range(len(text) - ORDER + 1) if text)
        for n in range(ORDER - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.cuts = {}
        for n, table in self.counts.items():
            c = Counter(table.values())
            n1, n2, n3, n4 = (c[k] for k in (1, 2, 3, 4))
            y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.0
            raw = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
            self.cuts[n] = [min(max(d, 0.05), k) for k, d in enumerate(raw, 1)]
        self.contexts = {n: defaultdict(lambda: [0, 0.0]) for n in self.counts}
        for n, table in self.counts.items():
            for g, k in table.items():
                entry = self.contexts[n][g[:-1]]
                entry[0] += k
                entry[1] += self.cut(n, k)

    def cut(self, n, k):
        return self.cuts[n][min(k, 3) - 1]

    def p(self, gram):
        n = len(gram)
        if n == 0:
            return 1 / (len(self.counts[1]) + 1)
        if gram[:-1] not in self.contexts[n]:
            return self.p(gram[1:])
        total, cuts = self.contexts[n][gram[:-1]]
        k = self.counts[n].get(gram, 0)
        return (max(k - self.cut(n, k), 0) if k else 0) / total + cuts / total * self.p(gram[1:])

    def logp(self, text):
        text = clean(text)
        return sum(math.log(self.p(text[i : i + ORDER])) for i in range(len(text) - ORDER + 1)) if text else 0.0


@pytest.fixture(scope="module")
def corpus(words):
    draw = random.Random(2)
    return [" ".join(draw.choices(words[:60], k=draw.randint(3, 40))) for _ in range(60)]


def test_probabilities(spark, make, corpus):
    model = kneser.train(spark, make([(i, t, "en", "s") for i, t in enumerate(corpus)]), ORDER)
    naive = Naive(corpus)
    rows = {r["gram"]: r for r in model.collect()}
    for n, table in naive.counts.items():
        for gram in table:
            assert math.isclose(math.exp(rows[gram]["logp"]), naive.p(gram), rel_tol=1e-9)
    chars = [*naive.counts[1], "☃"]  # one of them unseen
    for context in list(naive.contexts[ORDER])[:20]:
        assert math.isclose(sum(naive.p(context + c) for c in chars), 1, rel_tol=1e-9)


@pytest.mark.parametrize("shard_rows", [1_000_000, 150])
def test_scores(spark, make, corpus, messy, shard_rows):
    table = make([(i, t, "en", "s") for i, t in enumerate(corpus)])
    model = kneser.train(spark, table, ORDER)
    naive = Naive(corpus)
    texts = [r for r in messy if r[0] not in (6, 7)] + [(50 + i, t, "en", "s") for i, t in enumerate(corpus[:5])]
    texts += [(70, "never seen ☃ ÿþ 2024", "en", "s")]
    got = kneser.perplexities(spark, make(texts), model, ORDER, shard_rows).collect()
    found = sorted((r["doc_id"] or 0, r["n_symbols"], round(r["logp"], 3)) for r in got)
    want = sorted(
        (i or 0, max(len(clean(t)) - ORDER + 1, 0), round(naive.logp(t), 3)) for i, t, _, _ in texts
    )
    for a, b in zip(found, want, strict=True):
        assert a[:2] == b[:2] and math.isclose(a[2], b[2], rel_tol=1e-4, abs_tol=2e-3)


def test_quality(spark, make, corpus, words, messy):
    draw = random.Random(4)
    junk = [" ".join(w + "$$%%" for w in draw.choices(words, k=20)) for _ in range(10)]
    more = [" ".join(draw.choices(words[:60], k=30)) for _ in range(20)]
    rows = [(i, t, "en" if i % 2 else None, "s") for i, t in enumerate(corpus + more + junk)]
    trusted = spark.createDataFrame([(i,) for i in range(60)] + [(None,), (3,)], "doc_id long")
    for limit in (1000, 0):  # broadcast or joined
        got = kneser.quality(spark, make(rows), trusted, ORDER, broadcast_rows=limit).collect()
        kept = {r["doc_id"]: r["kept"] for r in got}
        assert all(kept[i] for i in range(80)) and not any(kept[i] for i in range(80, 90))
        assert len({r["threshold"] for r in got}) == 2
    odd = kneser.quality(spark, make(messy), trusted, ORDER).collect()
    assert len(odd) == len(messy)
    assert all(r["kept"] and r["perplexity"] is None for r in odd if r["doc_id"] in (3, 4, 5))


def test_the_threshold_is_that_of_texts_left_out(spark, make, corpus, words):
    """The quantile of scores by models of the other folds, as it is: repeated junk of known letters goes."""
    table = spark.createDataFrame([(i,) for i in range(60)], "doc_id long")
    fold = {r[0]: r[1] for r in table.selectExpr("doc_id", "pmod(xxhash64('fold', doc_id), 3)").collect()}
    left_out = []
    for f in range(3):
        naive = Naive([t for i, t in enumerate(corpus) if fold[i] != f])
        for i, t in enumerate(corpus):
            if fold[i] == f:
                left_out.append(math.exp(-naive.logp(t) / (len(clean(t)) - ORDER + 1)))
    junk = [" ".join([*words[3 * k : 3 * k + 4], words[100 + k][::-1]] * 5) for k in range(15)]
    full = Naive(corpus)
    ppl = [math.exp(-full.logp(t) / (len(clean(t)) - ORDER + 1)) for t in junk]
    rows = [(i, t, "en", "s") for i, t in enumerate(corpus + junk)]
    got = {r["doc_id"]: r for r in kneser.quality(spark, make(rows), table, ORDER, quantile=1.0).collect()}
    assert math.isclose(got[0]["threshold"], max(left_out), rel_tol=1e-3)
    assert all(got[60 + k]["kept"] == (p <= max(left_out)) for k, p in enumerate(ppl) if abs(p / max(left_out) - 1) > 0.01)
    assert any(1.01 * max(left_out) < p < 1.9 * max(left_out) for p in ppl)


def test_nothing_trusted_and_nothing_at_all(spark, make, messy):
    nobody = spark.createDataFrame([], "doc_id long")
    got = kneser.quality(spark, make(messy), nobody, ORDER).collect()
    assert len(got) == len(messy) and all(r["kept"] for r in got)
    assert kneser.quality(spark, make([]), nobody, ORDER).collect() == []
