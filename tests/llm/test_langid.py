import random
from collections import Counter

from tidegate.llm.langid import UNKNOWN, Profiles, identify, learn_profiles, ngrams, ranked


def naive_grams(text):
    out = Counter()
    word = ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            padded = f"\x01{word}\x01"
            out.update(word)
            for n in (2, 3):
                out.update(padded[i : i + n] for i in range(len(padded) - n + 1))
            word = ""
    return out


def number(gram):
    out = 0
    for c in gram:
        out = out << 21 | ord(c)
    return out


def test_ngrams():
    for text in ("Ab a-b, ÄÖ x", "", "123 !", "a", "日本 語", "İx"):
        assert Counter(ngrams(text).tolist()) == Counter({number(g): n for g, n in naive_grams(text).items()})


def test_distances(words):
    draw = random.Random(3)
    texts = {lang: " ".join(draw.choices(words[k : k + 60], k=300)) for k, lang in enumerate(["aa", "bb"])}
    rank = lambda t, top: [g for g, _ in sorted(((number(g), n) for g, n in naive_grams(t).items()), key=lambda x: (-x[1], x[0]))][:top]
    rows = [(lang, g, r) for lang, t in texts.items() for r, g in enumerate(rank(t, 50))]
    model = Profiles(rows, 50)
    for _ in range(20):
        text = " ".join(draw.choices(words, k=draw.randint(1, 30)))
        own = rank(text, 50)
        assert ranked(ngrams(text), 50).tolist() == own
        sums = {}
        for lang, t in texts.items():
            places = {g: r for r, g in enumerate(rank(t, 50))}
            sums[lang] = sum(min(50, abs(places[g] - r)) if g in places else 50 for r, g in enumerate(own))
        best = min(sorted(sums), key=sums.get)
        assert model.predict(text) == (best, 1 - sums[best] / (50 * len(own)))


def speak(draw, lang, n):
    letters = {"aa": "abcdefgh", "bb": "efghijkl"}[lang]
    return " ".join("".join(draw.choices(letters, k=4)) for _ in range(n))


def test_held_out_accuracy(spark, make):
    draw = random.Random(4)
    rows = [(i, speak(draw, lang, 40), lang, "s") for i, lang in enumerate(["aa", "bb"] * 150)]
    got = identify(spark, make(rows), per_language=50).where("held_out").collect()
    right = sum(rows[r["doc_id"]][2] == r["lang_pred"] for r in got)
    assert len(got) > 50 and right >= 0.95 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_the_label_is_no_input(spark, make):
    draw = random.Random(5)
    rows = [(i, speak(draw, lang, 40), lang, "s") for i, lang in enumerate(["aa", "bb"] * 50)]
    model = learn_profiles(spark, make(rows))
    assert len(model.grams) <= 600
    predicted = {r["doc_id"]: r["lang_pred"] for r in identify(spark, make(rows)).where("held_out").collect()}
    other = [(i, t, "aa" if i in predicted else lang, "other") for i, t, lang, _ in rows]
    again = {r["doc_id"]: r["lang_pred"] for r in identify(spark, make(other)).where("held_out").collect()}
    assert predicted == again


def test_odd_rows(spark, make, messy):
    got = identify(spark, make(messy)).collect()
    assert len(got) == len(messy)
    none = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert none[3] == none[4] == none[5] == (UNKNOWN, 0.0)
    assert none[1][0] in ("en", "de", "fr")
    assert not any(r["held_out"] for r in got if r["doc_id"] is None)


def test_nothing_to_learn_from(spark, make):
    got = identify(spark, make([(1, "text", None, "s")])).first()
    assert (got["lang_pred"], got["score"]) == (UNKNOWN, 0.0)
    assert identify(spark, make([])).collect() == []
