"""Registered queries against SQL, brute force or held-out labels on the small tables."""

import collections
import hashlib
import html
import re
import zlib

import duckdb
import numpy as np
import pytest

from checks.compare import canonical, oracle_frame
from shopmart.llm.oracle import ORACLE
from shopmart.llm.queries import QUERIES

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(table, sf=SMALL, columns="doc_id, text"):
    return duckdb.sql(f"SELECT {columns} FROM '{sf}/{table}.parquet'").fetchall()


def result(spark, name, sf=SMALL, key="doc_id"):
    return QUERIES[name](spark, sf).toPandas().set_index(key)


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    mine, theirs = QUERIES[name](spark, MEDIUM).toPandas(), oracle_frame(MEDIUM, ORACLE[name])
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert canonical(mine.convert_dtypes()) == canonical(theirs.convert_dtypes())


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        total = sum(int(d) if i % 2 == 0 else 2 * int(d) - 9 * (int(d) > 4) for i, d in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return 10 <= len(digits) <= 15 if kind == "phone" else True


def base_list(text):
    found = sorted(
        (m.start(), rank, kind, m.end())
        for rank, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if valid(kind, m.group())
    )
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in found)


def test_personal_data_equals_plain_patterns(spark):
    found = result(spark, "op2_personal_data")
    for doc_id, text in rows_of("documents"):
        assert found.base_sha256[doc_id] == hashlib.sha256(base_list(text).encode()).hexdigest()


def test_hard_texts_for_the_patterns(spark):
    from shopmart.llm import pii
    from pyspark.sql import functions as F

    texts = [
        "a@b.c_d@e.f a@b@c.d x.@y.z 1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 1.1.1.1.",
        "é\U0001f600 +1 (375) 555-4393) +12345 + 1234567890 +1234567890123456 4111 1111 1111 1111-2",
        "4111111111111111 4111-1111-1111-1111 4111  1111 0000000000000000 " + "7" * 30_000,
        "a" * 30_000 + " " + "x" * 20_000 + "@y.z",
        "+1((((((((((((((" * 500 + "+49 30 1234567",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = frame.select("doc_id", pii.span_list(pii.base_spans(F.col("text"))).alias("s")).collect()
    for row in spans:
        assert row["s"] == base_list(texts[row["doc_id"]])


def test_disclosing_terms(spark):
    """A name that only stands next to one address is removed everywhere; a common word is not."""
    from shopmart.llm import pii

    rows = [(i, f"filler{i} the mail of Zaphod a.b@c.org came on day{i} the end") for i in range(4)]
    rows += [(10 + i, "the end of the day and the mail of others " + " ".join(f"w{i}x{j}" for j in range(50))) for i in range(30)]
    rows += [(99, "only Zaphod alone")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found, terms = pii.find_spans(frame)
    assert {r["term"] for r in terms.collect()} >= {"zaphod"} and "the" not in {r["term"] for r in terms.collect()}
    alone = found.filter("id = 99").first()
    assert [(s["start"], s["end"]) for s in alone["terms"]] == [(5, 11)]
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(frame).collect()}
    assert "Zaphod" not in clean[99] and "<email>" in clean[0]


def test_quality_counts(spark):
    found = result(spark, "op4_quality_rules")
    for doc_id, text in rows_of("documents"):
        words = WORD.findall(text or "")
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        often = collections.Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
        lines = [line for line in (text or "").split("\n") if WORD.search(line)]
        row = found.loc[doc_id]
        counts = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)
        symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
        assert counts == (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered))
        assert row.base_failed == (len(words) < 20 or 100 * len(covered) > 30 * len(words))


def test_divergence_equals_plain_python(spark):
    """Both distances of a few documents, from histograms counted in Python."""
    from shopmart.llm import quality_rules as rules

    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = {r["row"]["doc_id"]: r for r in rules.assess(frame, carry=["doc_id"]).collect()}
    documents = rows_of("documents", columns="doc_id, lang, text")
    classes = [re.compile(p) for p in rules.CLASSES]

    def histogram(text):
        found = [next((i for i, p in enumerate(classes) if p.match(x)), 6) for x in text]
        return np.bincount(np.array(found, int), minlength=7).astype(float)

    totals, words = collections.defaultdict(lambda: np.zeros(7)), collections.defaultdict(collections.Counter)
    for _, lang, text in documents:
        totals[lang] += histogram(text)
        words[lang].update(WORD.findall(text))

    def distance(p, q):
        m = (p + q) / 2
        part = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m) if x > 0)
        return max(0.0, (part(p) + part(q)) / 2) ** 0.5

    checked = 0
    for doc_id, lang, text in documents[:60]:
        row = found[doc_id]
        if row["class_distance"] is not None:
            p, q = histogram(text), totals[lang]
            assert row["class_distance"] == pytest.approx(distance(p / p.sum(), q / q.sum()), abs=1e-9)
            checked += 1
        if row["word_distance"] is not None:
            n = sum(words[lang].values())
            common = [w for w in words[lang] if re.search(r"[^\W\d_]", w) and words[lang][w] * 2000 >= n]
            common = sorted(common, key=lambda w: (-words[lang][w], w.encode()))[:32]
            own = collections.Counter(WORD.findall(text))
            p = [own[w] / sum(own.values()) for w in common]
            q = [words[lang][w] / n for w in common]
            p, q = np.array([*p, 1 - sum(p)]), np.array([*q, 1 - sum(q)])
            assert row["word_distance"] == pytest.approx(distance(p, q), abs=1e-9)
    assert checked > 20


def test_packing(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = QUERIES["op5_best_fit_packing"](spark, SMALL).toPandas()
    expected = {}
    for doc_id, text in rows_of("documents"):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        edges = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        for piece, (a, b) in enumerate(zip(edges, edges[1:])):
            expected[doc_id, piece] = (a, b - a, zlib.crc32(ids[a:b].tobytes()))
    assert expected == {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in found.itertuples()}
    ordered = found.sort_values(["sequence_id", "offset"])
    by = ordered.groupby("sequence_id").length
    assert (ordered.offset == by.cumsum() - ordered.length).all() and by.sum().max() <= 2048
    assert by.ngroups <= 1.02 * found.length.sum() / 2048 + 1


def test_ids_of_odd_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    from shopmart.llm.packing import byte_encoding

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        encoding = byte_encoding(file.read())
    draw = np.random.default_rng(5)
    parts = ["<|endoftext|>", "<|", "|>", "'ll", "'", " ", "  ", "\n", "\x0b", "\x1c", "\x85", "\xa0", "\u200d", "\ufeff"]
    parts += ["a", "Zb", "12", "\u0663", "\xe9", "\u6f22", "\U0001f600", "\u0301", "\U0001e900", "."]
    for _ in range(3000):
        text = "".join(draw.choice(parts, draw.integers(0, 12)))
        ids = encoding.encode_to_numpy(text, allowed_special="all").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_best_fit_rules_equal_one_by_one():
    """Runs give as few sequences as best fit of single documents, longest first."""
    from shopmart.llm.packing import best_fit_rules

    draw = np.random.default_rng(1)
    for top in (30, 60, 100):
        sizes = sorted(draw.integers(1, top, 400).tolist(), reverse=True)
        gaps = []
        for size in sizes:
            fit = min((g for g in gaps if g >= size), default=None)
            if fit is not None:
                gaps.remove(fit)
            gaps.append((fit if fit is not None else 100) - size)
        rules = best_fit_rules(collections.Counter(sizes), 100)
        filled = collections.Counter()
        for length, _, count, a_sequence, first, offset in rules:
            for turn in range(count):
                assert filled[first + turn // a_sequence] == offset + turn % a_sequence * length
                filled[first + turn // a_sequence] += length
        assert sum(filled.values()) == sum(sizes) and max(filled.values()) <= 100
        assert len(filled) == len(gaps)


@pytest.mark.parametrize("name, label, least", [("op6_quality_model", "quality", 0.95), ("op10_toxicity", "toxic", 0.8)])
def test_held_out_labels(spark, name, label, least):
    sf = "/root/testdata/sf0.1" if label == "toxic" else MEDIUM
    found = result(spark, name, sf)
    held = [(zlib.crc32(str(d).encode()) % 5 == 0) if label == "quality" else (zlib.crc32(str(d).encode()) % 4 == 2) for d in found.index]
    assert (found.held_out == held).all() and found.score.between(0, 1).all()
    assert ((found.score >= 0.3).astype(int) == found.predicted).all()
    truth = dict(rows_of("labels", sf, f"doc_id, {label}"))
    tested = found[found.held_out & found.index.isin(list(truth))]
    right = [truth[d] == p for d, p in zip(tested.index, tested.predicted)]
    assert np.mean(right) >= least
    caught = [p for d, p in zip(tested.index, tested.predicted) if truth[d] == 1]
    assert np.mean(caught) >= least


def test_main_text(spark):
    found = result(spark, "op7_main_text", key="page_id")
    for page_id, page in rows_of("pages", columns="page_id, html"):
        inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
        plain = html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", inner)))
        assert found.text[page_id] == " ".join(plain.split()) and found.n_chars[page_id] == len(found.text[page_id])


def test_wrapper_drops_template_text():
    """Text that all pages of a host share goes, even inside the main region; named regions go as well."""
    from shopmart.llm.wrapper import extract, induce
    
    def page(n):
        return (
            f"<div class='top'>Site name</div><div id=page><p>Story {n} begins here and goes on for long.</p>"
            f"<p>Subscribe now</p><p>It ends with {n * 7}.</p><div class=comments><p>I like {n}</p></div></div>"
            f"<div class='sidebar'>Other {n}</div>"
        )

    wrapper = induce([page(n) for n in range(6)])
    assert extract(page(9), wrapper) == "Story 9 begins here and goes on for long. It ends with 63."


def _components(texts, width):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for key, text in texts:
        words = WORD.findall((text or "").translate(lower))
        whole = frozenset([tuple(words)] if words else [])
        sets[key] = frozenset(zip(*[words[i:] for i in range(width)])) if len(words) >= width else whole
    parent = {key: key for key in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(k for k in sets if sets[k])
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if 100 * small >= 80 * large:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= 80 * (small + large - shared):
                    a_root, b_root = sorted((root(a), root(b)))
                    parent[b_root] = a_root
    return {k: len(s) for k, s in sets.items()}, {k: root(k) for k in sets}


def test_near_copies_equal_all_pairs(spark):
    found = result(spark, "op8_lsh_forest", MEDIUM)
    sizes, components = _components(rows_of("documents", MEDIUM), 2)
    assert found.n_shingles.to_dict() == sizes and found.component_id.to_dict() == components
    assert (found.kept == (found.index == found.component_id)).all()


def test_crowd_of_near_copies(spark):
    """A large crowd of different near copies is one component, without all its pairs."""
    from shopmart.llm import lsh_forest

    draw = np.random.default_rng(4)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for doc in range(400):
        words = list(base)
        for place in draw.integers(0, 300, 5):
            words[place] = f"z{doc}p{place}"
        texts.append((doc, " ".join(words)))
    texts += [(1000 + i, " ".join(f"o{i}q{j}" for j in range(50))) for i in range(20)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r["id"]: r["component"] for r in lsh_forest.near_duplicates(frame, width=2).collect()}
    assert found == _components(texts, 2)[1]


def _variants(draw, base, count, edits, mark):
    """Near copies of a text that differ from it in ``edits`` words each."""
    for doc in range(count):
        words = list(base)
        for place in draw.choice(len(base), edits, replace=False):
            words[place] = f"{mark}{doc}p{place}"
        yield " ".join(words)


def test_crowd_around_one_text(spark):
    """Variants that are linked with the common original only, not with each other."""
    from shopmart.llm import lsh_forest

    draw = np.random.default_rng(6)
    base = [f"w{i}" for i in range(300)]
    texts = [(key, text) for key, text in enumerate(_variants(draw, base, 500, 15, "z"), 100)]
    texts.append((99_999, " ".join(base)))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r["id"]: r["component"] for r in lsh_forest.near_duplicates(frame, width=2).collect()}
    assert found == _components(texts, 2)[1]


def test_links_to_single_members_of_a_crowd(spark):
    """Each stray is linked with one member of a crowd, some with one stray only."""
    from shopmart.llm import lsh_forest

    draw = np.random.default_rng(7)
    base = [f"w{i}" for i in range(300)]
    crowd = list(_variants(draw, base, 300, 8, "z"))
    texts = list(enumerate(crowd))
    for number, member in enumerate(draw.choice(300, 40, replace=False)):
        (stray,) = _variants(draw, crowd[member].split(), 1, 13, f"s{number}")
        (further,) = _variants(draw, stray.split(), 1, 14, f"t{number}")
        texts += [(1000 + number, stray), (2000 + number, further)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r["id"]: r["component"] for r in lsh_forest.near_duplicates(frame, width=2).collect()}
    assert found == _components(texts, 2)[1]


LINES = {
    "This work is licensed under the GNU General Public License, version 3.": "GPL",
    "All rights reserved.": "proprietary",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
}


def test_licence_lines(spark):
    found = result(spark, "op9_license_scan", MEDIUM)
    for doc_id, text in rows_of("documents", MEDIUM):
        known = sorted({LINES[line] for line in (text or "").split("\n") if line in LINES})
        assert found.families[doc_id] == ",".join(known)


def test_routes_cost_least():
    """Overlapping sources: rerouting fills all quotas from first copies where that is possible."""
    from shopmart.llm.mixing import route

    patterns = {("a",): 10, ("a", "b"): 10, ("b", "c"): 10}
    flow = route(patterns, {"a": 15, "b": 5, "c": 10}, repeats=2)
    given = {p: sum(v for (own, _), v in flow.items() if own == p) for p in patterns}
    assert given == {("a",): 10, ("a", "b"): 10, ("b", "c"): 10}
    flow = route(patterns, {"a": 30, "b": 0, "c": 0}, repeats=2)
    assert sum(flow.values()) == 30 and all(s == "a" for _, s in flow)


def test_overlapping_sources(spark):
    from pyspark.sql import functions as F

    from shopmart.llm import mixing

    rows = [(i, " ".join(["w"] * (i % 7 + 1)), ["a"] if i % 3 else ["a", "b"]) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, tags array<string>")
    mixed = mixing.mix(frame, sources=F.col("tags"))
    total = mixed.agg(F.sum("taken"), F.sum("size"), F.max(F.col("taken") / F.col("size"))).first()
    assert abs(total[0] - 1.5 * total[1]) <= 2 and total[2] <= 2
    repeated = mixing.mixed_documents(frame, sources=F.col("tags")).select(F.sum(F.size(F.split("text", " "))))
    assert abs(repeated.first()[0] - total[0]) <= 2 * 7  # whole documents: one of up to seven words at each cut


def test_pipeline_equals_plain_stages(spark):
    """The stages' decisions, each against the plain query on its own input."""
    import corpus_pipeline
    from shopmart.llm.storage import store

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    first = store(corpus_pipeline.good_documents(spark, docs, SMALL), "t")
    kept = result(spark, "op4_quality_rules").kept
    assert {r["doc_id"] for r in first.collect()} == set(kept[kept].index)
    second = store(corpus_pipeline.distinct_documents(spark, first, SMALL), "t")
    best = {}
    for row in first.collect():
        best[row["text"]] = max(best.get(row["text"], -1), row["doc_id"])
    assert sorted(r["doc_id"] for r in second.collect()) == sorted(best.values())
    third = store(corpus_pipeline.unlike_documents(spark, second, SMALL), "t")
    components = _components([(r["doc_id"], r["text"]) for r in second.collect()], 5)[1]
    assert sorted(r["doc_id"] for r in third.collect()) == sorted(set(components.values()))
    fourth = store(corpus_pipeline.mixed_documents(spark, third, SMALL), "t")
    texts, sizes = {r["doc_id"]: r["text"] for r in third.collect()}, {}
    assert all(r["text"] == texts[r["doc_id"]] for r in fourth.collect())  # whole documents
    for frame, share in ((third, -1.5), (fourth, 1)):
        for row in frame.collect():
            sizes.setdefault(row["source"], []).append(share * len(WORD.findall(row["text"])))
    longest = sum(max(map(abs, own)) for own in sizes.values())
    assert abs(sum(map(sum, sizes.values()))) <= longest  # at most one document a source too many or too few
