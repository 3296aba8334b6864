"""Pieces, SimHash, line and exact deduplication, pseudonyms."""
import collections
import datetime
import hashlib
import re

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import exact_dedup, line_dedup, near_copies, pieces, pseudonyms, simhash
from riskloom.llm.components import connected_components
from riskloom.llm.shipping import prepare

SPACE = " \t\n\x0b\x0c\r"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def documents(spark, folder, limit=None):
    return spark.read.parquet(f"{folder}/documents.parquet")


# --- pieces ------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load()


def test_pieces_decode_to_the_text(docs_of, odd_rows):
    encoded = pieces.encode_documents(docs_of(odd_rows))
    assert {"pieces", "n_pieces", "lossless", "keep", "row", "k"} <= set(encoded.columns)
    rows = pieces.decode_documents(encoded).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        assert r.lossless and r.decoded == (r.text or "") and r.n_pieces == len(r.pieces)
    twice = [r.pieces for r in rows if r.doc_id == 8]
    assert twice[0] == twice[1]


def test_pieces_agree_with_the_library_decoder(vocabulary):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    texts = ["Hello world", "  two  spaces ", "tab\tnew\nline", "▁ mark", "naïve 漢字"]
    for ids, text in zip(pieces.sample(pieces.Store(vocabulary), texts, np.arange(5), 7), texts):
        assert model.decode(ids.tolist()) == text


def test_long_runs_equal_short_ones(vocabulary, monkeypatch):
    """A run filtered some positions at a time gives the pieces that the whole lattice gives."""
    rng = np.random.default_rng(6)
    letters = list("abcdefghijklmnopqrstuvwxyz") + ["é", "漢", "\U0001f389", "▁"]
    texts = ["".join(rng.choice(letters, n)) for n in (70, 200, 333, 1_000)] + ["two words " + "x" * 150 + " end", "aaaa" * 40]
    keys = np.arange(len(texts))
    whole_runs = pieces.sample(pieces.Store(vocabulary), texts, keys, 3)
    for size in (1, 7, 64, 100):
        monkeypatch.setattr(pieces, "LONG_UNIT", size)
        in_parts = pieces.sample(pieces.Store(vocabulary), texts, keys, 3)
        assert [p.tolist() for p in in_parts] == [p.tolist() for p in whole_runs]


def test_no_piece_boundary_is_fixed_in_a_long_run(vocabulary):
    text = "the" * 70_000 + "rest" * 10_000  # 250,000 characters
    table = vocabulary.decoder()
    crossed = False
    for key in range(4):
        ids = pieces.sample(pieces.Store(vocabulary), [text], np.array([key]), 42)[0]
        assert pieces.decode(table, ids.tolist()) == text
        ends = np.cumsum([len(table[i].decode()) for i in ids])
        crossed |= pieces.LONG_UNIT not in ends
    assert crossed


def _segmentations(vocabulary, word):
    """All ways to cut a word, with their weights, by plain recursion."""
    known = {t: (i, w) for i, t, w in zip(vocabulary.ids, vocabulary.texts, vocabulary.weights)}

    def cut(rest):
        if not rest:
            return [((), 0.0)]
        out = []
        for n in range(1, len(rest) + 1):
            if rest[:n] in known:
                i, w = known[rest[:n]]
                out += [((i, *tail), w + v) for tail, v in cut(rest[n:])]
        return out

    found = cut(word)
    weights = np.exp([w for _, w in found])
    return {ids: p for (ids, _), p in zip(found, weights / weights.sum())}


def test_pieces_are_sampled_in_proportion(vocabulary):
    chances = _segmentations(vocabulary, " the")
    n = 20_000
    drawn = pieces.sample(pieces.Store(vocabulary), ["the"] * n, np.arange(n), 3)
    seen = collections.Counter(tuple(d.tolist()) for d in drawn)
    assert set(seen) <= set(chances)
    for ids, p in chances.items():
        assert abs(seen[ids] / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-3


def test_pieces_do_not_depend_on_blocks_or_store(vocabulary, monkeypatch):
    texts = ["some words of prose and more", "words again", "漢 字 z"] * 5
    keys = np.arange(len(texts))
    whole = pieces.sample(pieces.Store(vocabulary), texts, keys, 1)
    monkeypatch.setattr(pieces, "BLOCK_UNITS", 4)
    small = pieces.sample(pieces.Store(vocabulary, edges=64), texts, keys, 1)
    assert all((a == b).all() for a, b in zip(whole, small))


def test_pieces_of_no_rows(docs_of):
    assert pieces.encode_documents(docs_of([])).count() == 0


# --- simhash -----------------------------------------------------------------

def plain_fingerprint(text):
    found = [w for w in re.split(r"[\x20\x09-\x0D]+", lower(text or "")) if w]
    if not found:
        return 0
    shingles = [" ".join(found[i:i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints):
    """(key, fingerprint) rows to the smallest key reachable over links of two bits."""
    values = sorted({f for _, f in prints})
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    least = {}
    for key, f in prints:
        r = root(f)
        if key is not None:
            least[r] = min(key, least.get(r, key))
    return {(key, f): least.get(root(f)) for key, f in prints}


def check_near_duplicates(df):
    prints = [(r.doc_id, plain_fingerprint(r.text)) for r in df.collect()]
    expected = plain_components(prints)
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(prints)
    assert collections.Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == collections.Counter(
        (k, f"{f:016x}", expected[k, f]) for k, f in prints
    )


def test_simhash_equals_brute_force(spark, folder):
    check_near_duplicates(documents(spark, folder))


def test_simhash_of_odd_rows(docs_of, odd_rows):
    check_near_duplicates(docs_of(odd_rows))
    assert simhash.near_duplicates(docs_of([])).count() == 0


def test_all_links_within_two_bits_are_found(spark):
    rng = np.random.default_rng(5)
    centres = [0, 2**64 - 1, *map(int, rng.integers(0, 2**63, 30, dtype=np.uint64))]
    values = set(centres)
    for c in centres:
        for _ in range(40):
            v = c
            for bit in rng.choice(64, rng.integers(1, 4), replace=False).tolist():
                v ^= 1 << bit
            values.add(v)
    values = sorted(values)
    expected = {
        frozenset((a, b)) for i, a in enumerate(values) for b in values[i + 1:] if (a ^ b).bit_count() <= 2
    }
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    found = simhash.links_within(spark.createDataFrame(signed, "fp bigint")).collect()
    assert len(found) == len(expected)  # each link once
    assert {frozenset((r.a % 2**64, r.b % 2**64)) for r in found} == expected


def test_the_exploded_side_of_the_range_join_is_not_broadcast(spark):
    """The planner sizes it like its input, of which it is thirty times."""
    distinct = spark.range(50).select(F.shiftleft("id", 20).alias("fp"))
    plan = simhash.links_within(distinct)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_keep_one_of_each_group(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    kept = simhash.keep_one(docs, simhash.near_duplicates(docs)).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(["1", "3", "6", "7", "None", "8", "9"])


def plain_near_copies(rows, least=0.8):
    """{(key, text): smallest key reachable} over links of five-word shingles."""
    sets = {}
    for _, text in rows:
        found = [w for w in re.split(r"[\x20\x09-\x0D]+", lower(text or "")) if w]
        sets[text] = frozenset(tuple(found[i:i + 5]) for i in range(max(1, len(found) - 4))) if found else frozenset()
    values = sorted(set(sets.values()), key=sorted)
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if min(len(a), len(b)) >= least * max(len(a), len(b)) and len(a & b) >= least * len(a | b):
                parent[root(a)] = root(b)
    smallest = {}
    for key, text in rows:
        r = root(sets[text])
        if key is not None:
            smallest[r] = min(key, smallest.get(r, key))
    return {(key, text): smallest.get(root(sets[text])) for key, text in rows}


def check_near_copies(df):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    expected = plain_near_copies(rows)
    got = near_copies.near_copies(df).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter((k, expected[k, t]) for k, t in rows)


def test_near_copies_equal_brute_force(spark, folder):
    check_near_copies(documents(spark, folder))


def test_near_copies_of_odd_rows(docs_of, odd_rows):
    check_near_copies(docs_of(odd_rows))
    assert near_copies.near_copies(docs_of([])).count() == 0
    with pytest.raises(ValueError):
        near_copies.near_copies(docs_of([]), least=0.5)


def compared(monkeypatch):
    """Numbers of pairs whose whole sets near_copies compares."""
    counts, similar = [], near_copies._similar

    def counting(pairs, sets, least):
        counts.append(pairs.count())
        return similar(pairs, sets, least)

    monkeypatch.setattr(near_copies, "_similar", counting)
    return counts


def test_documents_that_share_a_passage_do_not_all_meet(docs_of, monkeypatch):
    """600 documents of 360 words, 300 of them in all: below 0.8 each with each, 179,700 pairs."""
    counts = compared(monkeypatch)
    passage = " ".join(f"w{i}" for i in range(300))
    rows = [(i, passage + " " + " ".join(f"u{i}x{j}" for j in range(60)), "a") for i in range(600)]
    got = near_copies.near_copies(docs_of(rows)).collect()
    assert all(r.doc_id == r.component_id for r in got)
    assert counts[-1] == 0  # the prefix filter leaves none
    assert sum(counts) < 40 * 600


def test_the_prefix_filter_alone_equals_brute_force(docs_of, monkeypatch):
    monkeypatch.setattr(near_copies, "FEW", 0)
    monkeypatch.setattr(near_copies, "RARITIES", 64)  # many shingles share a counter
    monkeypatch.setattr(near_copies, "_spokes", lambda apart, *_: apart.select(
        F.col("node").alias("a"), F.col("node").alias("b")).limit(0))
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(160):  # similarities on both sides of 0.8, of different lengths
        words = list(base[:int(rng.integers(80, 121))])
        for at in rng.choice(len(words), int(rng.integers(0, 6)), replace=False).tolist():
            words[at] = f"x{rng.integers(0, 30)}"
        rows.append((i, " ".join(words), "a"))
    check_near_copies(docs_of(rows))


@pytest.mark.parametrize("least", [0.8, 0.9, 1.0])
def test_prefixes_of_similar_sets_meet(least):
    """Every pair of sizes and the least overlap that makes the similarity."""
    for small in range(1, 60):
        for large in range(small, int(small / least) + 1):
            overlap = next((o for o in range(small + 1) if o >= least * (small + large - o)), None)
            if overlap is not None:
                # in the worst case all that differs comes first
                assert small - overlap < near_copies.prefix_lengths(small, least)[0]
                assert large - overlap < near_copies.prefix_lengths(large, least)[1]


def test_the_stage_drops_planted_near_copies(spark, docs_of, folder):
    """One to four changed words of 200, beyond two bits of the fingerprint for most, and chains of such copies."""
    rng = np.random.default_rng(11)
    rows, originals = [], set()
    for group in range(60):
        words = [f"w{n}" for n in rng.integers(0, 5_000, 200)]
        originals.add(10 * group)
        rows.append((10 * group, " ".join(words), "a"))
        for copy, changed in enumerate((1, 2, 4), 1):
            other = list(words)
            for n, at in enumerate(rng.choice(200, changed, replace=False)):
                other[at] = f"changed{group}x{copy}x{n}"
            rows.append((10 * group + copy, " ".join(other), "a"))
        words[100:] = [f"v{n}" for n in rng.integers(0, 5_000, 100)]  # shares half and stays
        originals.add(10 * group + 9)
        rows.append((10 * group + 9, " ".join(words), "a"))
    docs = docs_of(rows)
    check_near_copies(docs)
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, folder).collect()}
    assert kept == originals


def test_the_stage_drops_documents_within_two_bits(spark, docs_of, folder):
    """One changed word of 40 leaves a five-word similarity below 0.8, and some such pairs are within two bits."""
    rng = np.random.default_rng(5)
    rows, expected, close = [], set(), 0
    for pair in range(2_000):
        words = [f"w{n}" for n in rng.integers(0, 5_000, 40)]
        texts = [" ".join(words), " ".join([*words[:20], f"changed{pair}", *words[21:]])]
        bits = (simhash.fingerprint(texts[0].encode()) ^ simhash.fingerprint(texts[1].encode())).bit_count()
        if bits <= 2 or pair < 3:
            rows += [(2 * pair, texts[0], "a"), (2 * pair + 1, texts[1], "a")]
            expected |= {2 * pair} if bits <= 2 else {2 * pair, 2 * pair + 1}
            close += bits <= 2
    assert close
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs_of(rows), folder).collect()}
    assert kept == expected


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 160)}}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def jobs_so_far(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()


def test_no_round_runs_over_finished_components(spark):
    """Each round is two writes of several exchanges, whose tasks the driver keeps account of."""
    links = [(i, 0) for i in range(1, 30)] + [(i, 100) for i in range(101, 130)]
    before = jobs_so_far(spark)
    found = connected_components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert jobs_so_far(spark) - before <= 6
    assert {r.node: r.component for r in found.collect()} == {i: i // 100 * 100 for i in [*range(30), *range(100, 130)]}


def test_the_near_duplicate_stage_takes_few_jobs(spark, docs_of, folder):
    """Every job adds to what the driver holds."""
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words, f"a{i}", f"b{i}"]), "a") for i in range(30)] + [(100, " ".join(words[:30]), "a")]
    before = jobs_so_far(spark)
    kept = corpus_pipeline.near_duplicate_stage(spark, docs_of(rows), folder).collect()
    jobs = jobs_so_far(spark) - before
    assert [r.doc_id for r in kept if r.doc_id >= 30] == [100] and jobs <= 170, jobs


def test_broadcasts_are_bounded_and_a_lower_bound_stays(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        for given, then in [("10485760b", "2097152"), ("64MB", "2097152"), ("1g", "2097152"), ("256k", "256k"), ("2mb", "2mb"), ("-1", "-1")]:
            spark.conf.set(key, given)
            prepare(spark)
            assert spark.conf.get(key) == then
    finally:
        spark.conf.set(key, before)


# --- lines -------------------------------------------------------------------

def plain_lines(rows, min_docs):
    owners = collections.defaultdict(set)
    for key, text in rows:
        for line in (text or "").split("\n"):
            owners[lower(line.strip(SPACE))].add((key, text))
    out = []
    for key, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not lower(x.strip(SPACE)) or len(owners[lower(x.strip(SPACE))]) < min_docs]
        out.append((key, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return collections.Counter(out)


def check_lines(df, min_docs):
    expected = plain_lines([(r.doc_id, r.text) for r in df.collect()], min_docs)
    got = line_dedup.drop_repeated_lines(df, min_docs=min_docs)
    assert collections.Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == expected
    return got


def test_lines_equal_brute_force(spark, folder):
    check_lines(documents(spark, folder), 10)


def test_lines_of_odd_rows(docs_of, odd_rows):
    got = check_lines(docs_of(odd_rows), 2)
    assert got.columns == [*docs_of([]).columns, "n_lines", "n_dropped"]
    assert line_dedup.drop_repeated_lines(docs_of([])).count() == 0


def test_lines_of_clashing_columns(docs_of):
    rows = [(i, f"shared\nown {i}", "a") for i in range(12)]
    docs = docs_of(rows).withColumnsRenamed({"keep": "n_lines", "row": "n_dropped", "k": "line"})
    got = line_dedup.drop_repeated_lines(docs)
    assert got.columns == [*docs.columns, "_n_lines", "_n_dropped"]
    assert all((r.text, r.n_lines, r.n_dropped, r._n_lines, r._n_dropped) == (f"own {r.doc_id}", "keep", "row", 2, 1) for r in got.collect())


def test_a_line_in_most_tasks(spark, docs_of):
    """One line fills several range partitions, beside lines on either side of the bound."""
    rows = [(i, f"shared\nown {i}\n Shared \nof few {i // 9}\nof ten {i // 10}", "a") for i in range(4_000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check_lines(docs_of(rows).repartition(8), 10)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_first_occurrence_can_stay(docs_of):
    rows = [(i, f"shared\nown {i}", "a") for i in range(500)]
    got = line_dedup.drop_repeated_lines(docs_of(rows), min_docs=2, keep_first=True).collect()
    assert sum("shared" in r.text for r in got) == 1 and all(f"own {r.doc_id}" in r.text for r in got)


# --- exact -------------------------------------------------------------------

@pytest.mark.parametrize("max_bits", [exact_dedup.MAX_BITS, exact_dedup.BITMAP_BITS])
def test_exact_dedup_equals_brute_force(docs_of, odd_rows, max_bits):
    rows = odd_rows + [(100 + i, f"text {i % 40}", "a") for i in range(200)]
    groups = collections.defaultdict(list)
    for key, text, _ in rows:
        groups[lower(text or "")].append(key)
    got = exact_dedup.mark_duplicates(docs_of(rows), max_bits=max_bits).collect()
    assert len(got) == len(rows)
    kept = collections.Counter()
    for r in got:
        text = next(lower(t or "") for k, t, _ in rows if k == r.doc_id and hashlib.sha256(lower(t or "").encode()).hexdigest() == r.text_sha256)
        keys = [k for k in groups[text] if k is not None]
        assert r.keep_id == (max(keys) if keys else None) and r.group_size == len(groups[text])
        kept[text] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert all(kept[t] == 1 for t in groups)
    assert exact_dedup.mark_duplicates(docs_of([])).count() == 0


def test_lower_casing_is_ascii_only(spark):
    from riskloom.llm.text import ascii_lower

    texts = ["ÀB", "ab", "ÉCOLE é", "İX", "ΑΣ", "aΣ", "ẞ", "plain ASCII", "é only Z"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", ascii_lower(F.col("t")).alias("l")).collect()
    assert all(r.l == lower(r.t) for r in got)


# --- pseudonyms --------------------------------------------------------------

def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def plain_feistel(values, radices, secret, kind):
    cut = len(values) // 2
    halves, sizes = [list(values[:cut]), list(values[cut:])], [radices[:cut], radices[cut:]]
    for turn in range(pseudonyms.ROUNDS):
        i = turn % 2
        text = "|".join([secret, kind, str(turn), ",".join(map(str, halves[1 - i]))])
        digest = hashlib.sha512(text.encode()).hexdigest()
        halves[i] = [
            (v + int(digest[j % 32 * 4:j % 32 * 4 + 4], 16)) % r for j, (v, r) in enumerate(zip(halves[i], sizes[i]))
        ]
    return halves[0] + halves[1]


def plain_date(year, month, day, secret):
    try:
        number = (datetime.date(year, month, day) - datetime.date(1800, 1, 1)).days
    except ValueError:
        return None
    if not 0 <= number < 189 * 773:
        return None
    a, b = plain_feistel([number // 773, number % 773], [189, 773], secret, "date")
    return datetime.date(1800, 1, 1) + datetime.timedelta(days=a * 773 + b)


def woven(form, digits):
    digits = iter(digits)
    return "".join(str(next(digits)) if c in "0123456789" else c for c in form)


def plain_coded(text, secret, kind, radix_of, value_of, symbol_of):
    movable = [c for c in text if c.isascii() and c.isalnum()]
    moved = iter(plain_feistel([value_of(c) for c in movable], [radix_of(c) for c in movable], secret, kind))
    return "".join(symbol_of(c, next(moved)) if c.isascii() and c.isalnum() else c for c in text)


def plain_pseudonym(m, secret):
    """A found value's pseudonym, case by case."""
    def whole(pattern):
        return regex.fullmatch(pattern.replace(r"\d", "[0-9]"), m)

    digits = [int(c) for c in m if c in "0123456789"]
    if "@" in m:
        local, domain = m.split("@")
        return plain_coded(
            local, secret, "email", lambda c: 10 if c.isdigit() else 26, lambda c: int(c) if c.isdigit() else ord(c.lower()) - 97,
            lambda c, v: str(v) if c.isdigit() else chr(v + (65 if c.isupper() else 97))) + "@" + domain
    if whole(pseudonyms.SECRET):
        upper = re.search("[A-F]", m)
        return plain_coded(m, secret, "secret", lambda c: 16, lambda c: int(c, 16), lambda c, v: f"{v:X}" if upper else f"{v:x}")
    if whole(pseudonyms.ADDRESS):
        octets = [int(o) for o in m.split(".")]
        return ".".join(map(str, plain_feistel(octets, [256] * 4, secret, "address"))) if max(octets) < 256 else m
    if whole(pseudonyms.ISO_DATE):
        found = plain_date(*map(int, m.split("-")), secret)
        return f"{found:%Y-%m-%d}" if found else m
    if whole(pseudonyms.DAY_FIRST_DATE):
        mark = "/" if "/" in m else "."
        day, month, year = map(int, m.split(mark))
        found = plain_date(year, month, day, secret)
        return found.strftime(f"%d{mark}%m{mark}%Y") if found else m
    if whole(pseudonyms.PHONE):
        number = digits[-10:]
        low = [2 if i in (0, 3) and d >= 2 else 0 for i, d in enumerate(number)]
        moved = plain_feistel([d - b for d, b in zip(number, low)], [10 - b for b in low], secret, "phone")
        return woven(m, digits[:-10] + [d + b for d, b in zip(moved, low)])
    if whole(pseudonyms.SOCIAL):
        area, group, serial = map(int, m.split("-"))
        if not (0 < area < 900 and area != 666 and group and serial):
            return m
        a, g, s = plain_feistel([area - 1 - (area > 666), group - 1, serial - 1], [898, 99, 9999], secret, "social")
        return f"{a + 1 + (a >= 665):03d}-{g + 1:02d}-{s + 1:04d}"
    if not luhn(m):
        return m
    body = plain_feistel(digits[:-1], [10] * (len(digits) - 1), secret, "card")
    check = next(c for c in range(10) if luhn("".join(map(str, [*body, c]))))
    return woven(m, [*body, check])


def plain_pseudonymise(text, secret):
    if text is None:
        return None, 0
    count = 0

    def replaced(found):
        nonlocal count
        new = plain_pseudonym(found.group(), secret)
        count += new != found.group()
        return new

    return regex.sub(pseudonyms.ALL.replace(r"\d", "[0-9]"), replaced, text), count


def test_pseudonyms_of_whole_documents_equal_plain_python(spark, folder, docs_of, odd_rows):
    got = pseudonyms.pseudonymise(documents(spark, folder), "key").select("doc_id", "text", "n_replaced").collect()
    texts = {r.doc_id: r.text for r in documents(spark, folder).collect()}
    assert all((r.text, r.n_replaced) == plain_pseudonymise(texts[r.doc_id], "key") for r in got)
    assert sum(r.n_replaced for r in got) > 20
    long = "On 2024-02-30 and 2024-02-28 from 10.1.2.3: " + "words and 4111 1111 1111 1111 more " * 5_000 + "ABCDEF0123456789ABCDEF0123456789ABCD, +49 (372) 555-7739"
    docs = docs_of([*odd_rows, (50, long, "a")]).withColumnsRenamed({"keep": "n_replaced", "row": "__found", "k": "__new"})
    made = pseudonyms.pseudonymise(docs, "key")
    assert made.columns == [*docs.columns, "_n_replaced"]
    for r in made.collect():
        original = long if r.doc_id == 50 else next(t for i, t, _ in odd_rows if i == r.doc_id)
        assert (r.text, r._n_replaced) == plain_pseudonymise(original, "key")
        assert (r.n_replaced, r.__found if hasattr(r, "__found") else r["__found"]) == ("keep", "row")


def test_pseudonyms_keep_the_format(docs_of):
    text = (
        "Mail John.Smith42@mail7.example.com, card 4111 1111 1111 1111 or 4111111111111111, not 4111111111111112. "
        "From 10.0.3.255, not 300.1.1.1; on 2024-02-29, 29.02.2024, not 2023-02-29; call +1 (372) 555-7739; "
        "number 078-05-1120, not 000-12-3456; token = \"0123456789abcdef0123456789abcdef01234567\"."
    )
    rows = [(1, text, "a"), (2, text, "a"), (3, None, "a"), (4, "", "b"), (5, "no data", None), (5, "no data", None)]
    got = pseudonyms.pseudonymise(docs_of(rows), "key").collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == 6 and by_id[1].text == by_id[2].text and by_id[1].n_replaced == 9
    assert by_id[3].text is None and by_id[4].text == "" and by_id[5].text == "no data" and by_id[5].n_replaced == 0
    out = by_id[1].text
    shape = lambda t: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", t))
    same = re.match(r"Mail (\S+)@mail7.example.com, card (\d{4} \d{4} \d{4} \d{4}) or (\d{16}), not 4111111111111112. "
                    r"From (\S+), not 300.1.1.1; on (\S+), (\S+), not 2023-02-29; call (\+1 \(\d{3}\) \d{3}-\d{4}); "
                    r"number (\d{3}-\d{2}-\d{4}), not 000-12-3456; token = \"([0-9a-f]{40})\"\.$", out)
    mail, spaced, card, address, iso, day_first, _, _, _ = same.groups()
    assert shape(mail).replace("0", "") and re.sub(r"\d", "9", shape(mail)) == "Aaaa.Aaaaa99"
    assert luhn(card) and spaced.replace(" ", "") == card and card != "4111111111111111"
    assert all(int(o) < 256 for o in address.split("."))
    assert iso == "-".join(reversed(day_first.split(".")))
    for gone in ("John", "4111 1111", "10.0.3.255", "2024-02-29", "555-7739", "078-05", "0123456789abcdef"):
        assert gone not in out
    assert pseudonyms.pseudonymise(docs_of([]), "key").count() == 0
    other = pseudonyms.pseudonymise(docs_of(rows), "other key").where("doc_id = 1").first().text
    assert other != out


def test_dates_permute_without_collision(spark):
    days = spark.range(189 * 773).select(
        F.date_format(F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("d")
    )
    got = days.select(pseudonyms.pseudonym(F.col("d"), "key").alias("p")).agg(
        F.countDistinct("p"), F.min("p"), F.max("p")
    ).first()
    assert tuple(got) == (189 * 773, "1800-01-01", "2199-12-31")


def test_feistel_matches_plain_python(spark):
    rows = [([3, 1, 4, 1, 5], [10] * 5), ([7], [26]), ([1, 2, 3, 4], [256] * 4)]
    df = spark.createDataFrame(rows, "v array<int>, r array<int>")
    got = df.select("v", "r", pseudonyms.feistel(F.col("v"), F.col("r"), "s", "x").alias("o")).collect()
    assert all(r.o == plain_feistel(r.v, r.r, "s", "x") for r in got)
