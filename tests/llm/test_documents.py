import collections
import hashlib
import re

import duckdb
import numpy as np
import pytest
import sentencepiece
from helpers import LOWER, MODEL, SCHEMA, awkward_documents, documents, words

from quarry.llm import language_id, license_scan, mixing, parity_join, pieces, suffix_dedup


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return documents(spark, [])


# SentencePiece


def test_pieces_match_the_library(docs, spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = pieces.token_digests(docs, MODEL).collect()
    expected = []
    for r in awkward_documents():
        ids = lib.encode(r[1] or "")
        expected.append((r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, got)) == sorted(expected)
    assert got[0].__fields__ == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


@pytest.mark.parametrize("text", ["", " ", "  a b", "▁x y", "▁▁ a", "あ😀", "<s> <0x0A> </s><unk>", "x\x00y", "�", " " * 3000 + "x" + " " * 37, "aaaaaaa" * 50, "🧿🧿 x", "xx yy　zz", "́́e"])
def test_pieces_odd_texts(text):
    lib, own = sentencepiece.SentencePieceProcessor(model_file=MODEL), pieces.codec(MODEL)
    assert own.encode(text) == lib.encode(text)
    assert own.decode(own.encode(text)) == lib.decode(lib.encode(text))


def test_pieces_round_trip_columns(docs):
    out = pieces.decode_ids(pieces.encode_ids(docs, MODEL), MODEL).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in out)
    assert out[0].__fields__ == [*SCHEMA.replace(" long", "").replace(" string", "").replace(" int", "").split(", "), "ids", "decoded"]


def test_pieces_empty(empty):
    assert pieces.token_digests(empty, MODEL).collect() == []


# language


def test_language(spark, docs, empty):
    rng = np.random.default_rng(1)
    vocabulary = {"en": "the of and that with from other thing".split(), "de": "der die und nicht eine über straße auch".split()}
    rows = []
    for i in range(300):
        lang = ["en", "de"][i % 2]
        rows.append((i, " ".join(rng.choice(vocabulary[lang], 12)).title(), lang if i % 5 else None, None, None, None, None, None, None, None))
    rows += [(1000, None, "en", *[None] * 7), (1001, "12 ** 4", "de", *[None] * 7), (None, "the of and", "en", *[None] * 7), (1003, "", None, *[None] * 7), (1004, "der" * 9000, None, *[None] * 7)]
    df = spark.createDataFrame(rows, SCHEMA)
    langs, p = language_id.learn(language_id.train_rows(df), MODEL)
    assert langs == ["de", "en"] and np.allclose(p.sum(axis=1), 1)
    got = {r.doc_id: r for r in language_id.identify(df, langs, p, MODEL).collect()}
    assert all(got[i].lang_pred == ["en", "de"][i % 2] and 0.5 <= got[i].score <= 1 for i in range(300))
    assert [got[i].lang_pred for i in (1000, 1001, 1003)] == ["und"] * 3 and got[1000].score == 0
    assert got[None].lang_pred == "en" and got[1004].lang_pred == "de"
    none, p = language_id.learn(language_id.train_rows(empty), MODEL)
    assert none == [] and {r.lang_pred for r in language_id.identify(docs, none, p, MODEL).collect()} == {"und"}
    assert language_id.identify(empty, langs, language_id.learn(language_id.train_rows(df), MODEL)[1], MODEL).collect() == []


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(3)
    p = rng.random(32000) / 1000
    auto, _ = language_id.automaton(MODEL)
    known = {w: v >> 8 for w, v in auto.items()}

    def total(word):
        if not word:
            return 1.0
        return sum(p[known[word[:n]]] * total(word[n:]) for n in range(1, len(word) + 1) if word[:n] in known) + language_id.STRAY * total(word[1:])

    for w in ["the", "straße", "xqz", "zł"]:
        assert np.isclose(np.exp(language_id.Lattice([w, "other"], MODEL).scores(p)[0]), total("▁" + w))


def test_language_query_matches_enumeration(spark, tmp_path):
    """The whole query against all segmentations written out: counts of one expectation step, then sums over words."""
    import functools
    import random
    import zlib

    from quarry.llm import queries

    rng = random.Random(12)
    pool = {"en": "the and of with this from some more", "de": "der die und nicht auch über mehr groß", "es": "el la de que los más año con"}
    rows = []
    for i in range(60):
        k = rng.choice(list(pool))
        rows.append((i, " ".join(rng.choice(pool[k].split()) for _ in range(rng.randint(1, 6))) + rng.choice([" 7", ".", " X"]), k if i % 7 else None, None, 1))
    rows += [(90, None, "en", None, 1), (91, "12 %", "de", None, 1), (92, "", None, None, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op3_language_id(spark, str(tmp_path)).collect()}
    auto, size = language_id.automaton(MODEL)
    known = {w: v >> 8 for w, v in auto.items()}

    @functools.cache
    def ways(text):
        """All segmentations: tuples of piece numbers, -1 for a character of no piece."""
        if not text:
            return [()]
        found = [(-1, *rest) for rest in ways(text[1:])]
        for n in range(1, len(text) + 1):
            if text[:n] in known:
                found += [(known[text[:n]], *rest) for rest in ways(text[n:])]
        return found

    def weights(word, p):
        return [(w, np.prod([language_id.STRAY if x < 0 else p(x) for x in w])) for w in ways("▁" + word)]

    letters = lambda t: re.findall(r"[^\W\d_]+", (t or "").lower())
    out = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, *_ in rows}
    model = {}
    for k in sorted(pool):
        uses = np.full(size, 0.1)
        for i, t, lang, *_ in rows:
            if lang == k and not out[i]:
                for word in letters(t):
                    all_ways = weights(word, lambda x: language_id.START)
                    total = sum(v for _, v in all_ways)
                    for w, v in all_ways:
                        for x in w:
                            if x >= 0:
                                uses[x] += v / total
        model[k] = uses / uses.sum()
    for i, t, *_ in rows:
        words_ = letters(t)
        assert got[i].held_out == out[i]
        if not words_:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        logs = np.array([sum(np.log(sum(v for _, v in weights(w, lambda x, p=model[k]: p[x]))) for w in words_) for k in sorted(model)])
        odds = np.exp(logs - logs.max())
        assert got[i].lang_pred == sorted(model)[int(logs.argmax())] and np.isclose(got[i].score, 1 / odds.sum(), atol=1e-4)


def test_long_words_are_scored_whole():
    """Against the matrix form where that does not underflow, and against logarithms all along."""
    rng = np.random.default_rng(8)
    p = rng.random((3, 32000)) / 500
    auto, _ = language_id.automaton(MODEL)
    known = {w: v >> 8 for w, v in auto.items()}

    def logs(word, own):
        text = "▁" + word
        alpha = [0.0]
        for j in range(1, len(text) + 1):
            ways = [alpha[j - 1] + np.log(language_id.STRAY)] + [alpha[j - n] + np.log(own[known[text[j - n : j]]]) for n in range(1, min(j, 20) + 1) if text[j - n : j] in known]
            alpha.append(np.logaddexp.reduce(ways))
        return alpha[-1]

    for word in ["straße", "theotherthing" * 3, "x" * 45, "字" * 41, "theандтhe字" * 70, "der" * 400, "q字" * 300]:
        got = language_id.long_score(word, np.ascontiguousarray(p.T), MODEL)
        assert np.allclose(got, [logs(word, own) for own in p], rtol=1e-10)
        if len(word) <= language_id.WORD:
            assert np.allclose(got, [language_id.Lattice([word], MODEL).scores(own)[0] for own in p])
    scorer = language_id.Scorer(["a", "b", "c"], p, MODEL)
    text = "the straße " + "der" * 400 + " 1 " + "der" * 400
    (best, score), = scorer.predict([text])
    sums = np.array([logs("the", own) + logs("straße", own) + 2 * logs("der" * 400, own) for own in p])
    assert best == "abc"[sums.argmax()] and np.isclose(score, 1 / np.exp(sums - sums.max()).sum())


def test_expected_counts_sum_to_segmentation_lengths():
    p = np.full(32000, 0.01)
    counts = language_id.Lattice(["ab"], MODEL).expected(p, np.array([2.0]))
    assert counts.sum() > 0 and counts.max() <= 2.0000001


def test_held_out_is_crc32(spark):
    import zlib

    rows = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", language_id.held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


# mixing


def test_mixing_matches_sql_and_keeps_its_promises(docs):
    own = duckdb.connect()
    own.register("documents", docs.select("doc_id", "text", "source").toPandas())
    expected = own.execute(mixing.MIX_SQL.replace("\\x20\\x09-\\x0D", "\\x20\\x09-\\x0D")).fetchall()
    out = mixing.mix(docs)
    got = out.select("doc_id", "size", "source_size", "target", "taken", "passes", "position").collect()
    norm = lambda rows: sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in rows)
    assert norm(got) == norm(expected)
    assert out.columns.count("size") == 1
    by = collections.defaultdict(int)
    targets = {}
    source = {r[0]: r[3] for r in awkward_documents()}
    for r in got:
        assert r.taken <= 3 * r.size and (r.size == len(words(dict((x[0], x[1]) for x in awkward_documents())[r.doc_id])))
        by[source[r.doc_id]] += r.taken
        targets[source[r.doc_id]] = r.target
    assert all(abs(by[s] - targets[s]) <= 1 for s in by)
    assert abs(sum(targets.values()) - sum(r.size for r in got)) < 1e-6
    positions = [r.position for r in got if r.position is not None]
    assert positions == sorted(positions) and all(0 <= p <= 1 for p in positions)


def test_mixing_caps_small_sources(spark):
    rows = [(1, "a " * 10, None, "a", *[None] * 6), (2, "b " * 1000, None, "b", *[None] * 6), (3, "c", None, "c", *[None] * 6)]
    got = {r.doc_id: r for r in mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[1].target, got[3].target) == (30.0, 3.0) and got[2].target == 1011 - 33
    assert (got[1].taken, got[3].taken, got[2].taken) == (30, 3, 978)


def test_mixing_empty(empty, spark):
    assert mixing.mix(empty).collect() == []
    assert mixing.mix(spark.createDataFrame([(1, None, None, None, *[None] * 6)], SCHEMA)).first().taken == 0


def test_readings(docs):
    got = collections.Counter(r.doc_id for r in mixing.readings(docs).collect())
    taken = {r.doc_id: r for r in mixing.mix(docs).collect()}
    for i, r in taken.items():
        if r.doc_id not in (3, 45) and r.size:
            assert got[i] == int(r.taken / r.size + 0.5)


# licenses


def brute_license(text):
    import re

    w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    found = [(i, label) for i in range(len(w)) for phrase, label in license_scan.PHRASES.items() if w[i : i + len(phrase.split())] == phrase.split()]
    return len(w), len(found), min((i for i, _ in found), default=None), max((i for i, _ in found), default=None), ",".join(sorted({x for _, x in found}))


def test_licenses(spark, docs, empty):
    extra = ["MIT License", "the mit license and apache license; Apache License", "GNU General Public License GNU general public", "cc-by CC BY mit", "mit mit license license",
             license_scan.TEMPLATES["mit-text"], license_scan.TEMPLATES["mit-text"].replace("free of charge", "entirely free of charge"), "Permission is hereby granted, free of charge, to any person"]
    rows = [*awkward_documents(), *[(5000 + i, t, *[None] * 8) for i, t in enumerate(extra)], (None, "mit license", *[None] * 8)]
    got = license_scan.scan(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_base, str(r.first_word), str(r.last_word), r.base_labels) for r in got) == sorted(
        (x[0] is None, x[0] or 0, *(str(v) if i in (2, 3) else v for i, v in enumerate(brute_license(x[1])))) for x in rows
    )
    by = {r.doc_id: r for r in got}
    assert "mit-text" in by[5005].labels and "mit-text" in by[5006].labels and by[5005].score == 1.0
    assert by[5007].labels == "" and all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    assert license_scan.scan(empty).collect() == []


def test_licenses_with_insertions(spark):
    """Words inserted into a notice split its span; halves in the wrong order are no notice."""
    cases, want = [], []
    for name in ("mit-text", "gpl-notice"):
        w = license_scan.TEMPLATES[name].split()
        half, third = len(w) // 2, len(w) // 3
        put = "these six words were put in".split()
        cases += [w[:half] + put + w[half:], w[:third] + put + w[third : 2 * third] + put * 30 + w[2 * third :], w[:half] + w[half + 5 :], w[half:] + put + w[:half], w[:half] + put]
        want += [name, name, name, "", ""]
    got = license_scan.scan(documents(spark, [(i, " ".join(c), *[None] * 8) for i, c in enumerate(cases)])).collect()
    assert [(r.labels if r.n_base == 0 else ",".join(sorted(set(r.labels.split(",")) - {"gpl"}))) for r in sorted(got, key=lambda r: r.doc_id)] == want


def brute_labels(text):
    """The method's own labels and the score, from lists of words: runs of k words in common, diagonals, spans, shares."""
    cut = lambda t: re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    w, found, best = cut(text), set(), 0.0
    for name, template in license_scan.TEMPLATES.items():
        t = cut(template)
        k = license_scan.K if len(t) >= license_scan.K else 2
        n = len(t) - k + 1
        by = collections.defaultdict(set)
        for i in range(len(w) - k + 1):
            for j in range(n):
                if w[i : i + k] == t[j : j + k]:
                    by[i - j].add(j)
        spans, last = [], None
        for d in sorted(by):
            if last is None or d - last > license_scan.GAP:
                spans.append([set(), [], []])
            spans[-1][0] |= by[d]
            spans[-1][1] += by[d]
            spans[-1][2] += [d + j for j in by[d]]
            last = d
        shape = sorted((min(at), max(at), min(i), max(i), len(s)) for s, at, i in spans)
        most = max((s[-1] for s in shape), default=0)
        if most < license_scan.SHARE * n <= sum(s[-1] for s in shape):
            chain = []
            for a, z, i, j, votes in shape:
                chain.append((z, j, votes + max((c[2] for c in chain if c[0] < a and c[1] < i), default=0)))
            most = max(c[2] for c in chain)
        if most >= license_scan.SHARE * n:
            found.add(name)
            best = max(best, min(1.0, most / n))
    return found, best


def test_labels_and_scores_match_brute_force(spark):
    """Cut, doubled, mixed and interrupted notices, ties and repeated runs of words inside one span."""
    import random

    rng = random.Random(21)
    names = list(license_scan.TEMPLATES)
    texts = ["", None, "all rights reserved", "copyright all rights reserved copyright all rights", " ".join(["free software you can"] * 40)]
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 3)):
            w = license_scan.TEMPLATES[rng.choice(names)].split()
            a = rng.randint(0, len(w) // 2)
            w = w[a : rng.randint(a + 1, len(w))] if rng.random() < 0.6 else w
            for _ in range(rng.randint(0, 4)):
                at = rng.randint(0, len(w))
                w = w[:at] + rng.choice([[], ["put"], ["some", "words", "in", "here", "now"], w[max(0, at - 5) : at]]) + w[at + rng.randint(0, 2) :]
            parts += w + ["and"] * rng.randint(0, 6)
        texts.append(" ".join(parts))
    got = {r.doc_id: r for r in license_scan.scan(documents(spark, [(i, t, *[None] * 8) for i, t in enumerate(texts)])).collect()}
    labelled = 0
    for i, t in enumerate(texts):
        own, share = brute_labels(t)
        base = set(filter(None, got[i].base_labels.split(",")))
        assert set(filter(None, got[i].labels.split(","))) == own | base, t
        assert np.isclose(got[i].score, 1.0 if got[i].n_base else share)
        labelled += bool(own)
    assert 30 < labelled < len(texts)


def test_license_plan_has_no_python(docs):
    plan = license_scan.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# shingle join


def brute_classes(rows, k=5):
    sets = {}
    for r in rows:
        w = words(r[1])
        sets[r[0]] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    part = {i: i for i in sets}

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 4 * both >= 3 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = root(i), root(j)
                    part[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_jaccard_classes(spark, docs, empty):
    expected = brute_classes(awkward_documents())
    got = parity_join.jaccard_classes(docs).collect()
    assert len(got) == len(awkward_documents())
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
    assert any(i != c for i, (_, c) in expected.items())
    assert parity_join.jaccard_classes(empty).collect() == []


def test_jaccard_small_sets_and_chains(spark):
    """Sets near the threshold in all small sizes, chains of links, and null ids."""
    import random

    rng = random.Random(9)
    rows = []
    for size in range(1, 24):
        base = [f"w{size}x{j}" for j in range(size + 4)]
        for cut in range(0, 4):
            rows.append((len(rows), " ".join(base[: size + 4 - cut]), *[None] * 8))
            rows.append((len(rows), " ".join(base[cut:] + [f"z{rng.random()}" for _ in range(cut)]), *[None] * 8))
    chain = [f"c{j}" for j in range(60)]
    for step in range(12):
        rows.append((len(rows), " ".join(chain[step * 4 : step * 4 + 44] + [f"q{j}" for j in range(step)]), *[None] * 8))
    got = parity_join.jaccard_classes(spark.createDataFrame([*rows, (None, "a b c d e f", *[None] * 8)], SCHEMA)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == brute_classes(rows)
    assert [r.component_id for r in got if r.doc_id is None] == [None]


@pytest.mark.parametrize("held", [1, 40, 3000])
def test_jaccard_in_parts(spark, monkeypatch, held):
    """Buckets that are matched part by part, with one segment that all texts share: the same classes in bounded memory."""
    monkeypatch.setattr(parity_join, "HELD", held)
    rng = np.random.default_rng(5)
    line = "one line that stands in every text of this table and is never changed"
    rows = []
    for i in range(120):
        own = [f"w{int(x)}" for x in rng.integers(0, 10**6, 25)]
        rows.append((len(rows), " ".join(own) + " " + line, *[None] * 8))
        if i % 3 == 0:
            own[int(rng.integers(0, 25))] = "other"
            rows.append((len(rows), " ".join(own) + " " + line, *[None] * 8))
    got = parity_join.jaccard_classes(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_classes(rows)


def test_parts_of_a_bucket_tell_what_the_whole_tells():
    rng = np.random.default_rng(6)
    sig, own = rng.integers(0, 40, 500).astype(np.uint64), rng.integers(0, 90, 500)
    want = {}
    for s, o in zip(sig.tolist(), own.tolist(), strict=True):
        want.setdefault(s, set()).add(o)
    for step in (1, 7, 100, 500):
        before, edges, members = None, [], {}
        for a in range(0, 500, step):
            before, (star, rows) = parity_join._met_again(sig[a : a + step], own[a : a + step], before)
            edges += list(zip(star["x"], star["y"], strict=True))
            for g, o in zip(rows["x"], rows["y"], strict=True):
                members.setdefault(g, set()).add(o)
        assert members == {s: m for s, m in want.items() if len(m) > 1}
        near = {(x, y) for x, y in edges}
        for m in members.values():  # the edges hold each group together
            reached, todo = set(), [min(m)]
            while todo:
                x = todo.pop()
                if x not in reached:
                    reached.add(x)
                    todo += [b if a == x else a for a, b in near if x in (a, b)]
            assert m <= reached


def test_segments_always_meet():
    """Any two near sets share a signature: checked on random pairs around the bound."""
    rng = np.random.default_rng(4)
    for _ in range(1500):
        size = int(rng.integers(1, 90))
        a = rng.integers(0, 2**63, size, dtype=np.uint64)
        cut = int(rng.integers(0, size // 4 + 2))
        b = np.concatenate([a[cut:], rng.integers(0, 2**63, int(rng.integers(0, size // 4 + 2)), dtype=np.uint64)])
        a, b = np.unique(a), np.unique(b)
        if parity_join.near(a, b) and not np.array_equal(a, b):
            assert np.intersect1d(parity_join.segments(a), parity_join.segments(b)).size
            x, y = parity_join.folded([parity_join.sketch(a), parity_join.sketch(b)])
            assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b)) <= parity_join.difference(len(a) + len(b))


def test_one_of_each(docs):
    got = [r.doc_id for r in parity_join.one_of_each(docs).collect()]
    assert sorted(got) == sorted({i for i, (_, c) in brute_classes(awkward_documents()).items() if i == c})


# repeated strings


def covered(rows, length):
    """Of each text, the mask of bytes in a string of length bytes that starts anywhere else too."""
    texts = [(r[1] or "").encode() for r in rows]
    seen = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        gone = bytearray(len(t))
        upto = 0
        for j in range(len(t) - length + 1):
            if seen[t[j : j + length]] > 1:
                for x in range(max(j, upto), j + length):
                    gone[x] = 1
                upto = j + length
        yield t, gone


def runs(gone):
    edges = [j for j in range(len(gone) + 1) if (gone[j - 1] if j else 0) != (gone[j] if j < len(gone) else 0)]
    return list(zip(edges[::2], edges[1::2], strict=True))


def brute_removal(rows, length, passage=240, least=50):
    out = []
    short = covered(rows, min(passage, length))
    for r, (t, gone), (_, near) in zip(rows, covered(rows, length), short, strict=True):
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        passages = sum(len(re.findall(rb"[^\x20\x09-\x0D]+", t[a:b])) >= least for a, b in runs(near))
        out.append((r[0], len(t), sum(gone), len(runs(gone)), hashlib.sha256(kept).hexdigest(), passages))
    return out


def nulls_first(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r))


def repeating_documents():
    """Passages of 40 to 70 words in several texts, null ids, one id with two texts, and copies of short and long texts."""
    rng = np.random.default_rng(11)
    word = lambda: "".join(rng.choice(list("abcdeé"), int(rng.integers(2, 9))))
    text = lambda n: " ".join(word() for _ in range(n))
    rows = []
    for n in (40, 49, 51, 55, 60, 70, 90):
        passage = text(n)
        rows += [(len(rows) + j, f"{text(30)} {passage} {text(20 + 5 * j)}") for j in range(3)]
    shared, long = text(110), text(60)
    rows += [(None, shared), (500, shared), (None, f"{text(9)} {shared}"), (600, f"{shared} {text(12)}"), (600, text(80)), (600, f"{long} {shared[:300]}")]
    rows += [(None, long), (None, long), (700, long), (701, text(45)), (702, "a b " * 300), (703, "x" * 900)]
    return [(*r, *[None] * 8) for r in rows]


@pytest.mark.parametrize(("length", "gram", "passage", "least"), [(400, 80, 240, 50), (60, 16, 60, 0), (300, 40, 120, 20)])
def test_suffix_removal(docs, length, gram, passage, least):
    rows = awkward_documents()
    got = suffix_dedup.removal(docs, length=length, gram=gram, passage=passage, words=least).collect()
    expected = brute_removal(rows, length, passage, least)
    assert sorted(map(tuple, got)) == sorted(expected)
    assert any(0 < e[2] < e[1] for e in expected) and any(e[5] for e in expected)


@pytest.mark.parametrize(("length", "gram", "passage"), [(400, 80, 240), (400, 128, 400), (200, 30, 150)])
def test_suffix_removal_by_text(spark, length, gram, passage):
    """Null ids and the texts of one id count like all others."""
    rows = repeating_documents()
    got = suffix_dedup.removal(spark.createDataFrame(rows, SCHEMA), length=length, gram=gram, passage=passage).collect()
    assert nulls_first(got) == nulls_first(brute_removal(rows, length, passage))
    assert got[0].__fields__ == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passages"]


def test_suffix_removal_empty(empty, spark):
    assert suffix_dedup.removal(empty).collect() == []
    got = suffix_dedup.removal(spark.createDataFrame([(None, "x" * 500, *[None] * 8), (1, None, *[None] * 8)], SCHEMA)).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in got) == [(0, 0), (500, 500)]


def test_suffix_removal_in_chunks(spark, monkeypatch):
    """More distinct spans round one anchor than a chunk holds."""
    monkeypatch.setattr(suffix_dedup, "CHUNK", 8)
    rng = np.random.default_rng(2)
    passage = "".join(rng.choice(list("abcdefgh "), 300))
    rows = [(i, "".join(rng.choice(list("abcd "), 100)) + passage + "".join(rng.choice(list("abcd "), 100)), *[None] * 8) for i in range(40)]
    got = suffix_dedup.removal(spark.createDataFrame(rows, SCHEMA), length=200, gram=50).collect()
    assert sorted(map(tuple, got)) == sorted(brute_removal(rows, 200))


def test_suffix_order():
    rng = np.random.default_rng(0)
    for trial in range(200):
        text = bytes(rng.integers(0, 2 if trial % 2 else 256, int(rng.integers(0, 200))).astype(np.uint8))
        assert suffix_dedup.suffix_order(text, 1000).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_cleaned_keeps_whole_characters(spark):
    passage = "äöü" * 100
    rows = [(1, "xä" + passage + "ß one", None, None, 0, *[None] * 5), (2, "yö" + passage + "ñ two", None, None, 0, *[None] * 5), (3, None, None, None, None, *[None] * 5), (4, passage * 2, None, None, 0, *[None] * 5)]
    got = {r.doc_id: r for r in suffix_dedup.cleaned(spark.createDataFrame(rows, SCHEMA), words=0).collect()}
    assert set(got) >= {1, 2, 3} and got[3].text is None
    assert got[1].text.endswith("ß one") and got[1].n_chars == len(got[1].text) < 20


def brute_cleaned(rows):
    """(id, text) of the rows that cleaned() leaves."""
    expected = []
    for r, (t, gone) in zip(rows, covered(rows, 240), strict=True):
        left = t
        for a, b in reversed([x for x in runs(gone) if len(t[x[0] : x[1]].split()) >= 50]):
            while a < b and t[a] & 0xC0 == 0x80:
                a += 1
            while b > a and b < len(t) and t[b] & 0xC0 == 0x80:
                b -= 1
            left = left[:a] + left[b:]
        if left.split() or left == t:
            expected.append((r[0], left.decode()))
    return expected


def test_cleaned_matches_brute_force(spark):
    rows = repeating_documents()
    got, expected = suffix_dedup.cleaned(spark.createDataFrame(rows, SCHEMA)).collect(), brute_cleaned(rows)
    assert nulls_first((r.doc_id, r.text) for r in got) == nulls_first(expected)
    assert len(got) < len(rows) and {t for _, t in expected} - {r[1] for r in rows}
