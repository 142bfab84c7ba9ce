import random

import pyarrow as pa

from tidegate.llm.decontam import Index, _masks, best_match, find_leaks, normal_words


def edit_distance(item, text):
    """The least word edits from the item to any run of the text."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for word in text:
        new = [0]
        for i, mine in enumerate(item):
            new.append(min(row[i] + (mine != word), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best


def spoil(draw, words, text, edits):
    out = list(text)
    for _ in range(edits):
        at = draw.randrange(len(out))
        kind = draw.randrange(3)
        if kind == 0:
            out[at] = draw.choice(words)
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, draw.choice(words))
    return out


def test_matching_is_exact(words):
    draw = random.Random(4)
    few = words[:8]
    for _ in range(300):
        item = draw.choices(few, k=draw.randint(1, 70))
        text = draw.choices(few, k=draw.randint(0, 90))
        hashed, _ = normal_words(pa.array([" ".join(item)]))
        seen, _ = normal_words(pa.array([" ".join(text)]))
        assert best_match(hashed, _masks(hashed), seen.tolist())[0] == edit_distance(item, text)


def test_recall_at_the_largest_rate(spark, make, words):
    draw = random.Random(6)
    items = [(k, " ".join(draw.choices(words, k=draw.randint(12, 60)))) for k in range(80)]
    docs, truth = [], set()
    for i in range(400):
        k, item = draw.choice(items)
        core = spoil(draw, words, item.split(), int(0.2 * len(item.split())))
        docs.append((i, " ".join(draw.choices(words, k=30) + core + draw.choices(words, k=30)), "en", "s"))
        if edit_distance(item.split(), docs[-1][1].split()) <= int(0.2 * len(item.split())):
            truth.add((i, k))
    found = find_leaks(spark, make(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in found}
    assert len(pairs & truth) >= 0.93 * len(truth)
    text, item = {d[0]: d[1].split() for d in docs}, dict(items)
    for r in found:  # and all of them are right
        run = text[r["doc_id"]][r["first_word"] : r["last_word"] + 1]
        assert edit_distance(item[r["item_id"]].split(), run) == r["distance"] <= 0.2 * r["item_words"]


def test_recall_of_every_item_length(words):
    draw = random.Random(16)
    for m in [*range(1, 26), 30, 45]:
        most = int(0.2 * m)
        items = [draw.choices(words, k=m) for _ in range(60)]
        index = Index(list(range(60)), [" ".join(x) for x in items], 0.2, 4, 2, 17)
        texts = [draw.choices(words, k=20) + spoil(draw, words, x, most) + draw.choices(words, k=20) for x in items]
        truth = {i for i, x in enumerate(items) if edit_distance(x, texts[i]) <= most}
        found = {(d, i) for d, i, *_ in index.search(*normal_words(pa.array([" ".join(x) for x in texts])))}
        assert truth and found >= {(i, i) for i in truth}, m  # recall 1 at the largest rate


def test_exact_passages_are_all_found(spark, make, words):
    draw = random.Random(7)
    items = [(k, " ".join(draw.choices(words, k=draw.randint(1, 40)))) for k in range(50)]
    docs = [(i, "Foo! " + items[i][1].upper() + ", bar.", "en", "s") for i in range(50)]
    table = spark.createDataFrame(items, "item_id long, text string")
    for block in (20_000, 7):  # in one block and in several
        got = find_leaks(spark, make(docs), table, block_items=block).where("distance = 0").collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} >= {(i, i) for i in range(50)}


def test_clean_documents(words):
    draw = random.Random(8)
    index = Index([0], [" ".join(draw.choices(words, k=30))], 0.2, 4, 2, 17)
    texts = pa.array([" ".join(draw.choices(words, k=500)) for _ in range(50)])
    assert list(index.search(*normal_words(texts))) == []


def test_odd_rows(spark, make, messy):
    items = [(1, messy[0][1]), (1, messy[0][1]), (None, "one two three"), (3, None), (4, ""), (5, "...")]
    got = find_leaks(spark, make(messy), spark.createDataFrame(items, "item_id long, text string")).collect()
    found = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["item_id"] or 0) for r in got)
    assert found == [(False, -5, 1), (False, 1, 1), (False, 1, 1), (False, 2, 1), (False, 8, 0), (False, 10, 0), (True, 0, 1)]


def test_empty_tables(spark, make, messy):
    none = spark.createDataFrame([], "item_id long, text string")
    assert find_leaks(spark, make(messy), none).collect() == []
    assert find_leaks(spark, make([]), spark.createDataFrame([(1, "a b")], "item_id long, text string")).collect() == []
