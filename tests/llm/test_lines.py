import random
import re
from collections import Counter, defaultdict

from tidegate.llm.lines import COUNTS, cleaned, line_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def naive(rows, floor=10, min_words=10, percent=20, min_left=0.2):
    """The counts and the verdict of each row, one row at a time."""
    distinct = set(rows)
    hosts = Counter(r[2] for r in distinct)
    norm = {r: Counter() for r in distinct}
    for r in distinct:
        for line in (r[1] or "").split("\n"):
            if ws := WORD.findall(lower(line)):
                norm[r][" ".join(ws)] += len(ws)
    stands = defaultdict(set)
    for r in distinct:
        for line in norm[r]:
            stands[r[2], line].add(r)
    out = []
    for r in rows:
        text = r[1] or ""
        ws = WORD.findall(text)
        grams = Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))
        hit = {i + k for i in range(len(ws) - 4) if grams[tuple(ws[i : i + 5])] > 1 for k in range(5)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        removed = 0
        for line, n in norm[r].items():
            there = stands[r[2], line]
            keeper = min(there, key=lambda x: (x[0] is not None, x[0] or 0))
            if len(there) > floor + hosts[r[2]].bit_length() and keeper[0] != r[0]:
                removed += n
        failed = len(ws) < min_words or 100 * len(hit) > percent * len(ws)
        left = len(ws) - removed
        out.append(
            (
                r[0],
                len(ws),
                sum(map(len, ws)),
                sum(text.count(c) for c in "#*$%&|<>"),
                len(lines) - len(set(lines)),
                len(hit),
                failed,
                not failed and left >= min_words and left >= min_left * len(ws),
            )
        )
    return sorted(out, key=repr)


def check(spark, make, rows, **limits):
    got = line_quality(spark, make([(i, t, "en", s) for i, t, s in rows]), **limits)
    found = [tuple(r) for r in got.select("doc_id", *COUNTS, "base_failed", "kept").collect()]
    assert sorted(found, key=repr) == naive(rows, **limits)
    return got


def test_random_documents(spark, make, words):
    draw = random.Random(1)
    common = [" ".join(draw.choices(words, k=12)) for _ in range(4)]
    rows = []
    for i in range(150):
        own = [" ".join(draw.choices(words, k=draw.randint(1, 15))) for _ in range(draw.randint(0, 5))]
        lines = own + draw.choices(common, k=draw.randint(0, 3))
        if draw.random() < 0.2:
            lines += lines
        draw.shuffle(lines)
        rows.append((i, draw.choice(["\n", "\r\n", " \n\t"]).join(lines), draw.choice("aaab")))
    kept = [r["kept"] for r in check(spark, make, rows, floor=3).collect()]
    assert 0 < sum(kept) < len(kept)


def test_a_common_line_stays_in_one_document(spark, make, words):
    line = " ".join(words[:30])
    rows = [(i, line if i % 3 else line + "\n" + " ".join(words[100 + i : 140 + i]), "h") for i in range(60)]
    got = check(spark, make, rows, floor=5)
    assert {r["doc_id"] for r in got.collect() if r["kept"]} == set(range(0, 60, 3))


def test_the_limit_is_alike_in_hot_hosts(spark, make, words):
    """A passage in a hundredth of a large host is over the limit as it is in a small one."""
    passage = " ".join(words[:60])
    own = lambda i: " ".join(words[(i * 7 + k * 3) % 400] + str(i) for k in range(20))
    rows = [(i, own(i) + ("\n" + passage if i % 100 < 1 else ""), "hot") for i in range(4000)]
    rows += [(10_000 + i, own(i) + "\n" + passage, "cold") for i in range(40)]
    got = check(spark, make, rows)
    cut = {r["doc_id"] for r in got.where("n_removed_lines > 0").collect()}
    assert cut == {i for i in range(100, 4000, 100)} | {10_000 + i for i in range(1, 40)}


def test_cleaned_texts(spark, make, words):
    """The kept documents come back without the removed lines, all else as it was."""
    draw = random.Random(8)
    common = [" ".join(words[k * 20 : k * 20 + 12]) for k in range(3)]
    rows = []
    for i in range(120):
        lines = [f"{w} {i} " + " ".join(draw.choices(words, k=14)) for w in "ab"]
        lines += [draw.choice(["", "  ", "\t"])] + [draw.choice([c, c.upper(), "  " + c.replace(" ", "\t")]) for c in draw.sample(common, 2)]
        draw.shuffle(lines)
        rows.append((i, draw.choice(["\n", "\r\n"]).join(lines) + draw.choice(["", "\n"]), "en", draw.choice("ab")))
    rows += [rows[5], (500, None, "en", "a"), (501, "", "en", "a")]
    got = cleaned(spark, make(rows), floor=3)
    assert got.columns == make(rows).columns
    stands = defaultdict(set)
    for i, t, _, s in rows:
        for line in (t or "").split("\n"):
            if ws := WORD.findall(lower(line)):
                stands[s, " ".join(ws)].add(i)
    hosts = Counter(s for _, s in {(r[0], r[3]) for r in rows})
    want = []
    for i, t, _, s in rows[:-2]:
        gone = lambda line: (ws := WORD.findall(lower(line))) and len(there := stands[s, " ".join(ws)]) > 3 + hosts[s].bit_length() and min(there) != i
        parts = t.split("\n")
        kept = [p + ("\n" if k < len(parts) - 1 else "") for k, p in enumerate(parts) if not gone(p)]
        want.append((i, "".join(kept), s))
    found = [(r["doc_id"], r["text"], r["source"]) for r in got.collect()]
    assert sorted(found) == sorted(want)
    assert any(t != w[1] for w, (_, t, _, _) in zip(want, rows))
    assert all(r["n_chars"] == len(r["text"]) and r["row"] == "x" for r in got.collect())


def test_odd_rows(spark, make, messy):
    rows = [(i, t, s) for i, t, _, s in messy if i is not None]
    check(spark, make, rows)
    assert line_quality(spark, make([(i, t, lang, s) for i, t, lang, s in messy])).count() == len(messy)


def test_empty_table(spark, make):
    assert line_quality(spark, make([])).collect() == []
