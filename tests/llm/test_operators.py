"""Each operator against a brute-force version, and on odd inputs: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from retail_spark.llm import bitsliced, htmltext, language, minhash, mixing, packing, passages, pii, rabitq, toxicity
from retail_spark.llm.common import connected, shingle_hashes
from retail_spark.llm.queries import tokenizer_path

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, score double, part int, n_replaced string"


def docs(spark, rows):
    """rows of (doc_id, text, lang, source); the other columns have names that operators use themselves."""
    return spark.createDataFrame([(d, t, l, s, len(t or ""), 7, 0.5, 1, "x") for d, t, l, s in rows], DOCS)


def words(n, seed, size=400):
    r = random.Random(seed)
    return [f"w{r.randrange(size)}x{r.randrange(size)}" for _ in range(n)]


ODD = [(1, None, None, None), (2, "", "en", "a"), (3, " \t\n", "en", "a"), (4, "one", "en", None), (5, "one", "en", "a"), (5, "one", "en", "a"),
       (None, "no id here", None, "b"), (7, "x" * 50_000, "en", "a"), (8, " ".join(words(20_000, 1)), "en", "b"), (9, "a\x00b ퟿ é", "fr", "")]


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w)} if 0 < len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def components(rows, n):
    sets = {}
    for d, t in rows:
        sets.setdefault(d, []).append(shingles(t, n))
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {d: find(d) for d in ids}


def edited(text, share, seed):
    r = random.Random(seed)
    return " ".join(f"e{r.randrange(10 ** 6)}" if r.random() < share else w for w in text)


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates_against_all_pairs(spark, n):
    rows = [(100 * g + k, edited(words(30 + 40 * g, g), 0.01 * (k % 6), 1000 * g + k)) for g in range(1, 6) for k in range(12)]
    rows += [(900 + k, "two words" if k % 2 else "Two WORDS") for k in range(5)] + [(950, None), (951, ""), (952, "one"), (953, "ONE")]
    out = minhash.near_duplicates(docs(spark, [(d, t, None, None) for d, t in rows]), words=n).collect()
    assert {r.doc_id: r.component_id for r in out} == components(rows, n)
    assert {r.doc_id: r.n_shingles for r in out} == {d: len(shingles(t, n)) for d, t in rows}
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_every_pair_of_a_bucket_is_met(spark):
    """One bucket of 20 pairs, each alike with one another only: more than the rounds have centres for."""
    texts = [" ".join(words(60, g // 2) + (["more"] if g % 2 else [])) for g in range(40)]
    table = docs(spark, [(d, t, None, None) for d, t in enumerate(texts)])
    classes = spark.createDataFrame([(d, len(shingles(t, 2)), [7]) for d, t in enumerate(texts)], "rep bigint, n bigint, bands array<bigint>")
    found = {tuple(sorted((r.u, r.v))) for r in minhash._links(table, classes, 2, 80).collect()}
    assert found == {(g, g + 1) for g in range(0, 40, 2)}


def test_bin_values_estimate_similarity():
    rng = np.random.default_rng(0)
    hits = []
    for _ in range(60):
        a = rng.integers(0, 2 ** 63, 20).astype(np.uint64)
        b = np.append(a[:16], rng.integers(0, 2 ** 63, 4).astype(np.uint64))  # similarity 16 / 24
        values, filled = np.zeros((2, 128), np.uint64), np.zeros((2, 128), bool)
        for k, s in enumerate((np.unique(a), np.unique(b))):
            first = np.searchsorted(s, np.arange(128, dtype=np.uint64) << np.uint64(57))
            filled[k] = np.diff(np.append(first, len(s))) > 0
            values[k] = s[np.minimum(first, len(s) - 1)]
        x, y = minhash._densify(values, filled)
        hits.append((x == y).mean())
    assert abs(np.mean(hits) - 16 / 24) < 0.05


def test_connected_components(spark):
    r = random.Random(3)
    pairs = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100 + k, 101 + k) for k in range(30)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a != b:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    got = {x.node: x.root for x in connected(spark.createDataFrame(pairs, "u bigint, v bigint")).collect()}
    assert got == {x: find(x) for x in list(root)}


def test_mixing(spark):
    rows = [(k, " ".join(words(5 + 37 * k % 900, k)), None, ("s0", "s1", "s2", None)[min(3, k % 7)]) for k in range(120)]
    table = docs(spark, rows + [(500, None, None, "s0"), (501, "", None, "empty")])
    got = mixing.mix(table, block=64).toPandas()
    again = mixing.mix(table.repartition(7), block=64).toPandas()
    key = ["doc_id", "source", "size", "taken"]
    assert sorted(map(str, got[key].values.tolist())) == sorted(map(str, again[key].values.tolist()))
    sizes = {d: len(t.split()) for d, t, _, _ in rows}
    assert all(r["size"] == sizes.get(r.doc_id, 0) and r.taken <= 2 * r["size"] for _, r in got.iterrows())
    by = got.fillna({"source": "~"}).groupby("source").agg(size=("size", "sum"), target=("target", "max"), taken=("taken", "sum"))
    names, total = sorted(by.index), 1.5 * by["size"].sum()
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), total
    while True:  # the excess goes to the others until none is above
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * by["size"][s]}
        if not full:
            target |= share
            break
        target |= {s: 2.0 * by["size"][s] for s in full}
        open_ -= full
        left -= sum(target[s] for s in full)
        if not open_:
            break
    assert all(abs(by["target"][s] - target[s]) < 1e-6 and abs(by["taken"][s] - target[s]) <= 1 for s in names)


def test_schedule_ranks_are_the_slots_in_order(spark):
    targets = spark.createDataFrame([("a", 1000, 5.0, 2000.0, 0), ("b", 300, 2.0, 77.0, 1), (None, 64, 1.0, 64.0, 2)],
                                    "source string, source_size bigint, weight double, target double, place int")
    slots = mixing.schedule(targets, block=8).toPandas().sort_values("slot")
    for source, g in slots.fillna({"source": "~"}).groupby("source"):
        assert g["rank"].tolist() == list(range(len(g)))
    # any stretch of the schedule holds the sources in proportion
    n = len(slots)
    for k in range(20, n, 37):
        assert abs((slots["source"].iloc[:k] == "a").mean() - (slots["source"] == "a").mean()) < 0.1


def test_mixed_documents_hold_the_words_taken(spark):
    rows = [(k, " ".join(words(40 + k, k)), None, "abc"[k % 3]) for k in range(30)]
    table = docs(spark, rows)
    taken = {r.doc_id: r.taken for r in mixing.mix(table, block=16).collect()}
    out = mixing.mixed_documents(table, block=16)
    assert out.columns == table.columns
    text = {d: t for d, t, _, _ in rows}
    found = {}
    for r in out.collect():
        assert text[r.doc_id].startswith(r.text) and r.n_chars == len(r.text) and r.row == 7
        found[r.doc_id] = found.get(r.doc_id, 0) + len(r.text.split())
    assert found == {d: n for d, n in taken.items() if n}


def brute_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path()).encode(text or "", add_special_tokens=False).ids + [1]


def test_packing(spark):
    rows = [(k, " ".join(words(1 + 53 * k % 1500, k)), None, None) for k in range(60)] + [(100, None, None, None), (101, "", None, None),
            (102, "<|endoftext|>É. don't, 3.5 İ. “x”.", None, None), (102, "<|endoftext|>É. don't, 3.5 İ. “x”.", None, None)]
    out = packing.pack(docs(spark, rows), tokenizer_path()).toPandas()
    ids = {}
    for d, t, _, _ in rows:
        ids[d] = brute_ids(t)
    for _, r in out.iterrows():
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    assert out["length"].sum() == sum(len(ids[d]) for d, _, _, _ in rows)
    used = out.groupby("sequence_id")["length"].sum()
    assert used.max() <= 2048 and sum(packing.padded(int(u)) for u in used) <= 1.03 * used.sum() + 2048
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g["length"].cumsum().tolist()[:-1]]


def test_plan_uses_every_piece_and_is_near_its_bound():
    rng = np.random.default_rng(5)
    for n in (1, 3, 300, 20_000):
        lengths, counts = np.unique(np.clip(rng.lognormal(5.8, 1, n).astype(int), 1, 2047), return_counts=True)
        plan = packing.Plan(dict(zip(lengths.tolist(), counts.tolist())))
        need = dict.fromkeys(range(len(plan.size)), 0)
        for pattern, times in plan.uses:
            assert sum(n * int(plan.size[k]) for k, n in pattern.items()) <= plan.capacity
            for k, m in pattern.items():
                need[k] += m * times
        assert [need[k] for k in range(len(plan.size))] == plan.need.tolist()
        if n == 20_000:
            assert sum(t for _, t in plan.uses) * 2048 <= 1.01 * int((lengths * counts).sum())
    assert packing.Plan({}).uses == []


def test_surrogates(spark):
    rows = [(1, "Mail anna.b@x.org or ANNA.B@X.ORG, call +1 (017) 555-7713.", None, None), (2, "anna.b@x.org 4111 1111 1111 1111", None, None),
            (3, "Version 2.0, licensed 2004. Clean text, 12 apples.", None, None), (4, "Mrs. Anna Smith met Mr. Smith at 10.0.0.7.", None, None),
            (5, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', None, None)]
    table = docs(spark, rows + ODD)
    out = pii.deidentify(table)
    assert out.columns == [*table.columns, "_n_replaced"] and out.count() == table.count()
    got = {r.doc_id: r for r in out.where("doc_id < 6").collect()}
    one, two, four = got[1].text, got[2].text, got[4].text
    assert got[3].text == rows[2][1] and got[3]._n_replaced == 0
    mail = re.findall(r"\S+@[\w.]*\w", one)
    assert mail[0] == mail[1].lower() == re.findall(r"\S+@[\w.]*\w", two)[0] != "anna.b@x.org"
    card = re.search(r"\d{4} \d{4} \d{4} \d{4}", two)[0]
    assert card != "4111 1111 1111 1111" and pii._luhn(card.replace(" ", ""))
    assert re.fullmatch(r".*call \+\d \(\d{3}\) \d{3}-\d{4}\.", one)
    given, family, again = re.match(r"Mrs\. (\w+) (\S+) met Mr\. (\S+) at", four).groups()
    assert given in pii.GIVEN[("f", "latin")] and family == again != "Smith" and "10.0.0.7" not in four
    assert "04dbebab" not in got[5].text and re.fullmatch(r'token = "[0-9a-f]{40}"', got[5].text)
    assert out.where("doc_id = 5").count() == 2 + 1


def test_names_of_many_words_and_later_mentions():
    def found(text):
        return [(k, v) for _, _, k, v, _ in pii.Finder()(text)]

    assert found("Mr. John Ronald Smith left.") == [("given", "John"), ("given", "Ronald"), ("family", "Smith")]
    assert found("Mr. J. Smith and Dr. A. B. Lee") == [("given", "J."), ("family", "Smith"), ("given", "A."), ("given", "B."), ("family", "Lee")]
    assert found("Mrs. Ana de la Cruz") == [("given", "Ana"), ("family", "Cruz")]
    text = "Smith's Mr. John Smith called. Smith said Smithson met John."
    assert [text[a:b] for a, b, *_ in pii.Finder()(text)] == ["Smith", "John", "Smith", "Smith", "John"]


def test_surrogates_of_many_names_stay_apart(spark):
    names = [(k, f"Herr Name{chr(97 + k % 26)}{chr(97 + k // 26)}x war hier.", None, None) for k in range(200)]
    out = [r.text for r in pii.deidentify(docs(spark, names)).collect()]
    assert len(set(out)) == 200 and not any("Name" in t for t in out)


PAGE = ('<html><head><title>t</title></head><body><nav><ul><li><a href="/">{0}</a></li></ul></nav><div class="ad">{1}</div><article><h1>{2}</h1>'
        '<p><b>{3}&amp;&lt;<br>x<p>{4}</p></article><footer>&copy; {0}</footer></body></html>')


def test_main_text(spark):
    texts = [[" ".join(words(n, 7 * k + n)) + "." for n in (2, 9, 5, 60, 30)] for k in range(40)]
    rows = [(k, f"u{k}", PAGE.format(*t), 1) for k, t in enumerate(texts)] + [(90, None, None, 1), (91, "u", "", 1), (92, "u", "<p", 1), (92, "u", "<p", 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    out = {r.page_id: r for r in htmltext.main_text(pages, htmltext.learn(pages)).collect()}
    for k, t in enumerate(texts):
        assert out[k].text == f"{t[2]}\n\n{t[3]}&< x\n\n{t[4]}" and out[k].n_chars == len(out[k].text)
    assert out[90].text == out[91].text == "" and out[90].n_chars == 0


def test_marginals_are_those_of_all_labellings():
    model = htmltext.train([PAGE.format(*[" ".join(words(9, k))] * 5) for k in range(6)])
    tree = htmltext.Tree("<div class=ad><p>a, b</p></div><article>c<p>d</p></article>")
    got = model.marginals([tree])
    x, n = htmltext.measures([tree]), tree.n
    own = htmltext.TEMPER * np.array([model.bias + model._key(tree.key[i]) + sum(model.bins[b][x[b][i]] for b in model.bins) for i in range(n)])
    total, on = 0.0, np.zeros(n)
    for bits in range(2 ** n):
        y = [(bits >> i) & 1 for i in range(n)]
        weight = np.exp(sum(own[i] * y[i] for i in range(n)) + sum(model.edges[tree.kind[i], y[tree.parent[i]], y[i]] for i in range(1, n)))
        total, on = total + weight, on + weight * np.array(y)
    assert np.allclose(got, on / total, atol=1e-6)


def test_deep_and_broken_pages_do_not_crash():
    model = htmltext.train([PAGE.format("a", "b", "c", "d", "e")])
    for page in ("<div>" * 3000 + "x", "<" * 500, "<!--", "<script>x", "<a b='", "</p></div>", "<p>" * 2000, "&#xZZ;&#99999999;"):
        assert isinstance(model.texts([page])[0], str)


def test_passages(spark):
    shared, fuzzy = words(80, 1), words(120, 2)
    rows = [(1, words(30, 3) + shared + words(40, 4)), (2, words(50, 5) + shared + words(10, 6)), (3, fuzzy), (4, words(20, 7) + edited(fuzzy, 0.05, 1).split()),
            (5, words(200, 8)), (6, words(200, 8)), (7, words(40, 9)), (8, words(40, 9)), (9, words(60, 10)), (10, ["and"] * 300), (11, ["and"] * 200)]
    out = passages.repeated_passages(docs(spark, [(d, " ".join(w), None, None) for d, w in rows] + [(20, None, None, None), (None, "x", None, None)])).collect()
    got = {r.doc_id: r for r in out}
    assert set(got) == {2, 4, 6, 11}
    assert (got[2].start, got[2].stop, got[2].source_id, got[2].source_start, got[2].edits) == (50, 130, 1, 30, 0)
    assert got[4].source_id == 3 and got[4].n_words >= 80 and 0 < got[4].edits <= 12
    assert (got[6].source_id, got[6].n_words) == (5, 200)


def passages_of(spark, rows):
    found = passages.repeated_passages(docs(spark, [(d, " ".join(w), None, None) for d, w in rows])).collect()
    return {(r.doc_id, r.start, r.stop, r.source_id, r.source_start) for r in found}


def test_two_passages_of_a_pair(spark):
    head, foot = words(60, 1), words(60, 2)
    long = [words(200, k) for k in (5, 6)]
    rows = [(1, head + words(60, 3) + foot), (2, head + words(60, 4) + foot), (3, long[0] + words(80, 7) + long[1]), (4, long[0] + words(80, 8) + long[1])]
    assert passages_of(spark, rows) == {(2, 0, 60, 1, 0), (2, 120, 180, 1, 120), (4, 0, 200, 3, 0), (4, 280, 480, 3, 280)}


def test_passage_that_a_text_says_twice(spark):
    said, late = words(60, 1), words(70, 2)
    rows = [(1, words(20, 3) + said), (2, said + words(30, 4) + said), (3, late), (4, late[:40] + words(30, 5) + late)]
    assert passages_of(spark, rows) == {(2, 0, 60, 1, 20), (2, 90, 150, 1, 20), (4, 70, 140, 3, 0)}


def test_passage_whose_parts_stand_in_earlier_documents(spark):
    said = words(85, 1)
    rows = [(1, said[:45] + words(30, 2)), (2, words(30, 3) + said[40:]), (10, words(10, 4) + said + words(10, 5)), (20, words(20, 6) + said)]
    assert passages_of(spark, rows) == {(20, 20, 105, 10, 10)}


def test_chains_and_edits_against_brute_force():
    r = random.Random(2)
    for _ in range(40):
        n = r.randrange(1, 9)
        a, b = [r.randrange(40) for _ in range(n)], [r.randrange(40) for _ in range(n)]
        best = 0.0
        for mask in range(1, 2 ** n):
            c = sorted((a[i], b[i]) for i in range(n) if mask >> i & 1)
            if all(x < u and y < v for (x, y), (u, v) in zip(c, c[1:])):
                best = max(best, passages.K * len(c) - passages.GAP_COST * (c[-1][0] - c[0][0] + c[-1][1] - c[0][1]))
        top = passages.chains(a, b)[0]
        assert abs(passages.K * top[4] - passages.GAP_COST * (top[1] - top[0] + top[3] - top[2]) - best) < 1e-9
        x, y = [r.randrange(4) for _ in range(r.randrange(9))], [r.randrange(4) for _ in range(r.randrange(9))]
        d = list(range(len(y) + 1))
        for i, p in enumerate(x):
            e, d[0] = d[0], i + 1
            for j, q in enumerate(y):
                e, d[j + 1] = d[j + 1], min(d[j] + 1, d[j + 1] + 1, e + (p != q))
        assert passages.edits(x, y, 20) == d[-1]


def test_languages(spark):
    vocabulary = {"en": "the of and to in is that was for with".split(), "de": "der die und ist von mit nicht auch für".split(), "xx": "qa zo ku wi".split()}
    r = random.Random(0)
    rows = [(k, " ".join(r.choices(vocabulary[l], k=15)), l, None) for k, l in enumerate(list(vocabulary) * 30)]
    out = {x.doc_id: x for x in language.languages(docs(spark, rows + [(200, "123 !", "en", None), (201, None, "en", None), (202, "der die und", None, None)])).collect()}
    assert all(out[d].lang_pred == l for d, _, l, _ in rows) and out[202].lang_pred == "de"
    assert out[200].lang_pred == out[201].lang_pred == "und" and out[201].score == 0
    assert all(x.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= x.score <= 1 for d, x in out.items())


def test_rank_distance_is_cavnar_and_trenkle():
    profiles = language.Profiles({"a": np.array([5, 7, 9], np.uint64), "b": np.array([9, 5], np.uint64)}, size=3)
    own = language.ranked("aab")
    text_cost = {"a": 3 * min(3, len(own)), "b": 3 * min(3, len(own))}  # no n-gram in common: each costs the profile's length
    name, score = profiles.predict("aab")
    assert name == "a" and score == 1 - text_cost["a"] / (3 * min(3, len(own)))


def test_toxicity(spark):
    r = random.Random(1)
    rows, labels = [], []
    for k in range(400):
        toxic = r.random() < 0.3
        text = words(30, k)
        if toxic:
            text[r.randrange(30)] = r.choice(["vileword", "scumbag", f"loath{'abcdef'[k % 6]}"])
        rows.append((k, " ".join(text), None, None))
        labels.append((k, int(toxic)))
    out = {x.doc_id: x for x in toxicity.toxicity(docs(spark, rows + [(900, None, None, None), (901, "", None, None)]),
                                                  spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()}
    right = [out[k].predicted == t for k, t in labels if out[k].held_out]
    assert len(right) > 50 and np.mean(right) > 0.97 and out[900].predicted == out[901].predicted == 0
    nothing = toxicity.toxicity(docs(spark, rows[:5]), spark.createDataFrame([], "doc_id bigint, toxic int")).collect()
    assert all(x.predicted == 0 for x in nothing)


def test_label_model_shares_evidence_of_correlated_voters():
    rng = np.random.default_rng(0)
    y = (rng.random(3000) < 0.3).astype(float)
    single = (rng.random((3000, 3)) < np.where(y[:, None] == 1, 0.7, 0.05)).astype(float)
    copies = np.repeat((rng.random((3000, 1)) < np.where(y[:, None] == 1, 0.6, 0.3)).astype(float), 5, axis=1)
    model = toxicity.LabelModel(np.hstack([single, copies]), np.where(rng.random(3000) < 0.2, y, np.nan))
    assert (model.share[:3] > 0.9).all() and (model.share[3:] < 0.35).all()
    assert ((model.labels > 0.5) == (y == 1)).mean() > 0.9


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<float>, v int, block int")


def vector_rows():
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(0, 0.3, 20).astype(np.float32).tolist()) for k in range(300)]
    rows += [(400 + k, rows[17][1]) for k in range(30)] + [(500, [0.0] * 20), (17, rows[17][1])]
    return rows, rows + [(600, None), (601, [1.0, None]), (602, [float("nan")] * 20), (603, [float("inf")] * 20), (None, rows[3][1]), (700, [0.5, -0.5]), (750, [])]


def test_bit_sliced_search(spark):
    good, rows = vector_rows()
    got = {}
    for r in bitsliced.top_inner_products(vectors(spark, rows), F.col("vec_id") % 50 == 0, 5, block=64, queries=3).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    whole = {i: np.floor(256 * np.array(v, dtype=np.float64)).astype(int) for i, v in good}
    assert set(got) == {i for i in whole if i % 50 == 0}
    for q, found in got.items():
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:5]
        assert sorted(found) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]


def test_one_bit_codes_search(spark):
    good, rows = vector_rows()
    got = {}
    for r in rabitq.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, 10, block=64, queries=3).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    whole = {i: np.array(v, dtype=np.float64) for i, v in good if any(v)}
    hits = 0
    for q in (i for i in whole if i % 20 == 0):
        best = sorted((float(np.sqrt(((v - whole[q]) ** 2).sum())), i) for i, v in whole.items() if i != q)[:10]
        found = sorted(got[q])
        assert [s for _, _, s in found] == sorted(s for _, _, s in found) and 500 not in [i for _, i, _ in found]
        hits += len({i for _, i in best} & {i for _, i, _ in found}) / 10
    assert hits / len([i for i in whole if i % 20 == 0]) >= 0.9


def test_estimates_stay_within_their_bound():
    rng = np.random.default_rng(1)
    data, centre, turn = rng.normal(size=(500, 50)), np.zeros(50), rabitq.rotation(50)
    codes, length, own = rabitq.encode(data, centre, turn)
    query = rng.normal(size=(1, 50))
    guess, width = rabitq.estimate(codes, length, own, rabitq._rotated(query, centre, turn)[0][0])
    true = ((data - query) ** 2).sum(axis=1)
    assert (np.abs(guess - true) <= width).mean() > 0.97 and abs((guess - true).mean()) < 0.1 * true.mean()


@pytest.mark.parametrize("rows", [ODD, []])
def test_odd_and_empty_documents(spark, rows):
    table = docs(spark, rows)
    n = len(rows)
    labels = spark.createDataFrame([(5, 1), (None, None)] if rows else [], "doc_id bigint, toxic int")
    assert toxicity.toxicity(table, labels).count() == n and toxicity.keep_clean(table, labels).columns == table.columns
    assert minhash.near_duplicates(table).count() == n and minhash.keep_one(table).columns == table.columns
    assert pii.deidentify(table).count() == n
    assert mixing.mix(table).count() == n
    assert language.languages(table).count() == n
    assert packing.pack(table, tokenizer_path()).select("doc_id").count() >= n
    assert passages.repeated_passages(table).count() == 0
    assert mixing.mixed_documents(table).columns == table.columns
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert bitsliced.top_inner_products(none, F.col("vec_id") % 50 == 0, 5).count() == rabitq.nearest(none, F.col("vec_id") % 2 == 0, 5).count() == 0


def test_shingles_of_short_texts():
    w = np.arange(3, dtype=np.uint64)
    assert len(shingle_hashes(w, 2)) == 2 and len(shingle_hashes(w, 5)) == 1 and len(shingle_hashes(w[:0], 5)) == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    base = [(k, " ".join(words(120 + k, k)), "en", "ab"[k % 2]) for k in range(40)]
    rows = base + [(100 + k, edited(base[k][1].split(), 0.005, k), "en", "a") for k in range(10)] + [(200, "write to who@there.org now " * 9, "en", "a")]
    docs(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 0) for k in range(40)], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    kept = components([(d, t) for d, t, _, _ in rows], 5)
    assert set(out.doc_id) <= {d for d, c in kept.items() if d == c}
    assert out.groupby("sequence_id")["length"].sum().max() <= 2048
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "personal_data", "mix", "pack"]


def test_label_model_beats_majority_without_any_label():
    """Voters of either side, five of them copies of a poor one: accuracies are found with every label hidden."""
    rng = np.random.default_rng(3)
    y = rng.random(4000) < 0.3
    votes = [rng.random(4000) < np.where(y, on, off) for on, off in ((0.8, 0.05), (0.7, 0.1), (0.6, 0.05), (0.2, 0.8), (0.1, 0.6))]
    poor = rng.random(4000) < np.where(y, 0.5, 0.4)
    fires = np.array([*votes, *[poor] * 5], dtype=float).T
    side = np.array([1, 1, 1, -1, -1, 1, 1, 1, 1, 1])
    model = toxicity.LabelModel(fires, np.full(4000, np.nan), side=side)
    right, majority = ((model.labels > 0.5) == y).mean(), ((fires @ side > 0) == y).mean()
    assert right > 0.93 and right > majority + 0.1
    assert (model.share[5:] < 0.3).all() and (model.share[:5] > 0.9).all()
    assert np.abs(model.rate1[:5] - [0.8, 0.7, 0.6, 0.2, 0.1]).max() < 0.1


def test_given_labels_are_a_voter_with_estimated_rates():
    rng = np.random.default_rng(4)
    y = rng.random(4000) < 0.3
    fires = (rng.random((4000, 8)) < np.where(y[:, None], 0.8, 0.05)).astype(float)
    wrong = rng.random(4000) < 0.15
    model = toxicity.LabelModel(fires, np.where(wrong, ~y, y).astype(float))
    assert abs(model.given[0] - 0.85) < 0.04 and abs(model.given[1] - 0.15) < 0.04
    assert ((model.labels > 0.5) == y).mean() > 0.99
