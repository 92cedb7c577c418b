"""The ten operators against brute force, on the smallest tables and on a table of odd rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
BLANK = re.compile(r"[\x20\x09-\x0d]+")


def words(text):
    return [w for w in BLANK.split(text or "") if w]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [r.asDict() for r in docs.collect()]


#: Columns whose names the operators use inside.
CLASHING = ("id", "key", "size", "score", "b", "h", "fp", "text_sha256", "n_bytes", "shard", "item", "n", "words", "low", "t",
            "y", "l", "of", "__id", "__doc", "__of", "__copies", "__fp", "__key", "__drop_id", "__row", "__sha", "survives")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a long text, clashing names."""
    base = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau. "
    passage = "".join(f"shared passage word{k} " for k in range(14))
    texts = [(1, base * 4), (2, base * 4), (2, base * 4), (3, base.replace(" ", "\t\n") * 4), (4, None), (5, ""),
             (6, " \n\t "), (7, "x"), (8, "one two"), (None, base), (None, base), (None, None), (9, "äöü " * 60),
             (10, "".join(f"w{k} " for k in range(30000))), (11, "front " + passage + "end"),
             (12, "other start " + passage + "tail"), (13, "a" * 1000), (14, "ab" * 250), (14, "different text, same id"),
             (15, "\U0001F600 emoji \x0b vertical\x0cfeed\rreturn"), (16, "Nul \x00 byte " * 3)]
    data = [Row(doc_id=i, text=t, lang=(None, "en", "de")[k % 3], source=(None, "s1", "s2")[k % 3], n_chars=k,
                **{c: "clash" for c in CLASHING}) for k, (i, t) in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([tuple(r) for r in data], schema).repartition(3)


@pytest.fixture(scope="module")
def nothing(odd):
    return odd.filter("false")


# --- 1 toxicity -----------------------------------------------------------

def test_toxicity_folding_boundaries_and_exceptions():
    from ampere.llm.toxicity import ToxicityModel
    m = ToxicityModel({"idiot": 2.0, "loser": 1.0, "trash": 3.0, "réeux*": 4.0})
    a = m.automaton()
    hit = lambda t: m.matches(a, t)
    assert hit("you idiot") == (2.0, 1)
    assert hit("1D10T! ıdiоt, ＩＤＩＯＴ") == (6.0, 3)
    assert hit("a 10ser and a lo$er") == (2.0, 2)
    assert hit("idiots videoidiot idiotic") == (0, 0)
    assert hit("trash$$$ trash***") == (6.0, 2)
    assert hit("put it in the trash can") == (0, 0)
    assert hit("trash in the trash can") == (3.0, 1)
    assert hit("réeuxpa RÉEUXde reeuxpa aréeux") == (8.0, 2)
    assert hit("ìdïot") == (2.0, 1)
    assert hit("") == (0, 0)


def test_toxicity_single_letters_l_replaced():
    from ampere.llm.toxicity import ToxicityModel
    m = ToxicityModel({"bullshit": 2.0, "slit": 1.0, "idiot": 4.0, "kill*": 8.0}, exceptions=("kill bill",))
    a = m.automaton()
    hit = lambda t: m.matches(a, t)
    assert hit("bu1lshit bul|shit BU11SH!T bullshit") == (8.0, 4)
    assert hit("silt slit s1it") == (2.0, 2) and hit("ldlot") == (0, 0)
    assert hit("ki1lers kil1 a k111er") == (24.0, 3)
    assert hit("ki1l bil1, K!ll Bi1l") == (0, 0)


def test_toxicity_held_out_accuracy(spark):
    from ampere.llm.queries import op1_toxicity
    sf = "/root/testdata/sf0.1"
    got = op1_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    r = got.filter("held_out").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")),
                                   F.sum(((F.col("toxic") == 1) & (F.col("predicted") == 1)).cast("int")),
                                   F.sum("toxic")).first()
    assert r[0] > 0.97 and r[1] >= 0.85 * r[2]


def test_toxicity_odd_rows(spark, odd, nothing):
    from ampere.llm.toxicity import fit_toxicity, toxicity
    labels = spark.createDataFrame([(1, 1), (1, 0), (8, 0), (9, 0), (None, 1), (7, None), (3, 1)], "doc_id long, toxic int")
    m = fit_toxicity(odd, labels)
    out = odd.select(toxicity(m, F.col("text")).alias("s")).collect()
    assert len(out) == odd.count() and all(0 <= r.s <= 1 for r in out)
    assert fit_toxicity(nothing, labels).weights == {}
    assert fit_toxicity(odd, labels.filter("false")).weights == {}
    assert nothing.select(toxicity(m, F.col("text"))).collect() == []


# --- 2 exact dedup --------------------------------------------------------

def exact_brute(pairs):
    groups = defaultdict(list)
    for i, t in pairs:
        groups[BLANK.sub(" ", t or "")].append(i)
    out = []
    for i, t in pairs:
        n = BLANK.sub(" ", t or "")
        ids = groups[n]
        known = [x for x in ids if x is not None]
        keep = (min(known) if known else None) if len(ids) > 1 else i
        out.append((i, keep, len(ids), keep == i, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("which", ["docs", "odd", "nothing"])
def test_exact_groups(request, which):
    from ampere.llm.exact_dedup import exact_groups
    df = request.getfixturevalue(which)
    got = sorted(map(tuple, exact_groups(df, digest_all=True).collect()), key=repr)
    assert got == exact_brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def test_drop_copies(odd, nothing):
    from ampere.llm.exact_dedup import drop_copies
    out = drop_copies(odd)
    assert out.columns == odd.columns
    got = Counter(BLANK.sub(" ", r.text or "") for r in out.collect())
    every = {BLANK.sub(" ", r.text or "") for r in odd.collect()}
    assert set(got) == every and max(got.values()) == 1
    assert drop_copies(nothing).count() == 0


# --- 3 language id --------------------------------------------------------

def test_language_id_held_out(spark):
    from ampere.llm.queries import op3_language_id
    sf = "/root/testdata/sf0.01"
    got = op3_language_id(spark, sf).filter("held_out").join(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


def test_language_id_slices_and_odd_rows(docs, odd, nothing, monkeypatch):
    from ampere.llm import language_id as L
    m = L.fit_language_id(docs, rows_per_lang=60)
    texts = [r.text for r in docs.limit(20).collect()]
    whole = m.logits(texts)
    monkeypatch.setattr(L, "SLICE", 999)
    assert abs(m.logits(texts) - whole).max() < 1e-4
    monkeypatch.undo()
    out = {(r.doc_id, r.lang_pred) for r in L.identify_language(odd, m).collect()}
    assert {i for i, p in out if p == "und"} >= {4, 5, 6} and (7, "und") not in out
    assert L.identify_language(nothing, m).count() == 0
    assert L.fit_language_id(nothing) is None
    assert {r.lang_pred for r in L.identify_language(odd, None).collect()} == {"und"}


# --- 4 sharding -----------------------------------------------------------

@pytest.mark.parametrize("which,k", [("docs", 40), ("odd", 3)])
def test_shards(request, which, k, monkeypatch):
    from ampere.llm import sharding
    df = request.getfixturevalue(which)
    monkeypatch.setattr(sharding, "GROUPS_PER_TASK", 25)  # several levels of the tree
    monkeypatch.setattr(sharding, "FAN_IN", 3)
    monkeypatch.setattr(sharding, "ROWS_PER_SLOT_TASK", 2)
    got = sharding.shard_documents(df, k).collect()
    src = df.select("doc_id", "text").collect()
    assert len(got) == len(src)
    size = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in src)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == size
    by = defaultdict(set)
    for r in got:
        by[(r.text_crc32, r.size)].add(r.shard)
    assert all(len(s) == 1 for s in by.values())
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(k))


def test_shards_are_even(spark):
    from ampere.llm.sharding import shard_documents
    total = Counter()
    for r in shard_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), 40).collect():
        total[r.shard] += r.size
    assert max(total.values()) <= 1.001 * sum(total.values()) / 40


def test_differencing_is_tight(nothing):
    import numpy as np
    from ampere.llm.sharding import difference, shard_documents
    parts = []
    for s in (8, 7, 6, 5, 4):
        parts.append(np.array([s, 0], dtype=np.int64))
    sums, place = difference(parts, 2)
    assert sorted(sums) == [14, 16]  # the classic example: differencing leaves 2
    assert [sum(s for s, p in zip((8, 7, 6, 5, 4), place) if p[0] == q) for q in (0, 1)] == list(sums)
    assert shard_documents(nothing, 4).count() == 0


# --- 5 HTML ---------------------------------------------------------------

def text_of(source, low=()):
    from ampere.llm.html_extract import main_text
    return main_text(source, set(low))


def test_html_blocks():
    assert text_of(None) == "" and text_of("") == "" and text_of("<p>") == ""
    page = ('<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>'
            '<nav><ul><li>Menu</li></ul></nav><!-- x --><div class="ad">Buy</div><article><h1>Head &amp; line</h1>'
            '<p><b>One\n two<br>three<p>Four &lt;tag&gt; &#233;<span class="x">five</span></p>'
            '<div class="comments"><p>Reader</p></div><form><input>q</form><aside>side</aside>'
            '<p>Six</article><footer>&copy;</footer></body></html>')
    assert text_of(page) == "Head & line\n\nOne two three\n\nFour <tag> éfive\n\nSix"
    assert text_of("<p>a &am") == "a &am"
    assert text_of("<p>a<b>b</p>c") == "ab\n\nc"
    assert text_of("<p>kept</p><p clas") == "kept"
    assert text_of("<div class='cookie-notice'>n</div><div id=sidebar>s</div>text <script>x") == "text"
    assert text_of("1 < 2 and <p title=\"a>b\">x</p>") == "1 < 2 and\n\nx"
    assert text_of("<article><header><h1>T</h1><p>by me</p></header><p>x</p></article>") == "T\n\nx"
    assert text_of("<article>" + "<div>" * 3000 + "deep") == "deep"


def test_style_tree_removes_templates(spark):
    from ampere.llm.html_extract import extract_main_text
    page = ("<html><body><div class=top><p>Welcome to the site</p></div><div class=body><p>Story {0} first</p>"
            "<p>Story {0} second</p></div><div class=low><p>Imprint</p></div></body></html>")
    data = [(k, f"http://Host.example:80/{k}", page.format(k)) for k in range(20)]
    data += [(100, "http://lonely.example/", page.format(0)), (101, None, None), (102, "no url", "<p>t</p>"), (102, "no url", "<p>t</p>")]
    df = spark.createDataFrame(data, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract_main_text(df.withColumn("host", F.lit("clash"))).collect()}
    assert got[3] == "Story 3 first\n\nStory 3 second"
    assert got[100].startswith("Welcome") and got[101] == "" and got[102] == "t"
    assert extract_main_text(df).count() == len(data)
    assert extract_main_text(df.filter("false")).count() == 0


def test_html_whole_table(spark):
    from ampere.llm.queries import op5_html_extraction
    import html
    src = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = op5_html_extraction(spark, SMALL).collect()
    assert len(got) == len(src)
    for r in got:
        body = src[r.page_id].split("<article>")[1].split("</article>")[0]
        body = re.sub(r"<br>", " ", re.sub(r"</?b>", "", body))
        want = [re.sub(r"\s+", " ", html.unescape(x)).strip() for x in re.split(r"</?(?:p|h1)>", re.sub(r"<[^>]*$", "", body))]
        assert r.text == "\n\n".join(x for x in want if x)
        assert r.n_chars == len(r.text)


def test_style_tree_and_article_marks(spark):
    from ampere.llm.html_extract import extract_main_text
    teasers = ("<html><body><div class=x1><p>Story {0} is told here at some length, first part</p><p>and story {0} goes on</p>"
               "</div><article><p>Teaser {0}</p></article><article><p>More {0}</p></article></body></html>")
    inside = ("<html><body><p>Outside</p><article><div class=x2><p>Read us on paper as well</p></div><h1>Title {0}</h1>"
              "<p>Story {0} first</p><p>Story {0} second</p></article></body></html>")
    long = ("<html><body><div class=x3>" + "".join(f"<p>Template line {k}</p>" for k in range(30))
            + "</div><div class=x4><p>Story {0}</p></div></body></html>")
    data = [(k, f"http://{h}.example/", page.format(k)) for h, page, first in (
        ("teasers", teasers, 0), ("inside", inside, 100), ("long", long, 200)) for k in range(first, first + 20)]
    got = {r.page_id: r.text for r in extract_main_text(
        spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert got[3].startswith("Story 3 is told here at some length, first part\n\nand story 3 goes on")
    assert got[103] == "Title 103\n\nStory 103 first\n\nStory 103 second"
    assert got[203] == "Story 203"


def test_style_tree_counts_copies_once(spark):
    from ampere.llm.html_extract import extract_main_text
    page = ("<html><body><div class=x1><p>Welcome to the site</p></div><div class=content><p>Story {0} first</p>"
            "<p>Story {0} second</p></div></body></html>")
    data = [(k, "http://copies.example/", page.format("one")) for k in range(20)]
    data += [(k, "http://mostly.example/", page.format("one" if k < 170 else k)) for k in range(100, 200)]
    data += [(k, "http://few.example/", page.format(k % 7)) for k in range(300, 340)]  # under 8 distinct pages
    got = {r.page_id: r.text for r in extract_main_text(
        spark.createDataFrame(data, "page_id long, url string, html string").repartition(5)).collect()}
    assert len(got) == len(data)
    assert got[3] == "Welcome to the site\n\nStory one first\n\nStory one second"
    assert got[105] == "Story one first\n\nStory one second" and got[185] == "Story 185 first\n\nStory 185 second"
    assert got[301] == "Welcome to the site\n\nStory 6 first\n\nStory 6 second".replace("6", str(301 % 7))


# --- 6 packing ------------------------------------------------------------

@pytest.mark.parametrize("which", ["docs", "odd"])
def test_packing(request, which, monkeypatch):
    import numpy as np
    from tokenizers import Tokenizer

    from ampere.llm import packing
    from ampere.llm.queries import tokenizer_path
    df = request.getfixturevalue(which)
    monkeypatch.setattr(packing, "ITEMS_PER_GROUP", 8)
    monkeypatch.setattr(packing, "FAN_IN", 2)
    got = packing.pack_documents(df, tokenizer_path(), 2048).collect()
    tok = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for r in df.select("doc_id", "text").collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [0]
        cut = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        for p, (a, z) in enumerate(zip(cut, cut[1:])):
            want[(r.doc_id, p, a, z - a, zlib.crc32(np.array(ids[a:z], dtype="<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for seq in by.values():
        at = 0
        for o, n in sorted(seq):
            assert o == at
            at += n
        assert at <= 2048
    assert len(by) <= math.ceil(sum(r.length for r in got) / 2048) * 1.06 + 2


def test_best_fit_and_ids(nothing, rows):
    from tokenizers import Tokenizer

    from ampere.llm.packing import best_fit, encode, pack_documents
    from ampere.llm.queries import tokenizer_path
    bins, fills = best_fit([6, 5, 5, 4, 3, 2, 7, 8], 10)
    assert sum(fills) == 40 and max(fills) <= 10 and len(fills) == 4
    tok = Tokenizer.from_file(tokenizer_path())
    tok.encode_special_tokens = True
    odd = ["a  b", " a", "a ", "a \n b", "a  \nb", "x\n y  z", "  a \u3000b", "<|endoftext|> it's  'll ", "  ", "a\tb \t c", "\x00\x1c\x85"]
    for t in odd + [r["text"] for r in rows]:
        assert encode(tokenizer_path(), 0, t) == b"".join(
            i.to_bytes(4, "little") for i in tok.encode(t, add_special_tokens=False).ids) + bytes(4)
    assert pack_documents(nothing, tokenizer_path()).count() == 0


def test_packed_ids_are_those_of_the_file(spark):
    import numpy as np
    from tokenizers import Tokenizer

    from ampere.llm.packing import pack_documents
    from ampere.llm.queries import tokenizer_path
    tok = Tokenizer.from_file(tokenizer_path())
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n y", "<|endoftext| >", "plain"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.length, r.ids_crc32) for r in pack_documents(df, tokenizer_path()).collect()}
    for k, t in enumerate(texts):
        ids = tok.encode(t, add_special_tokens=False).ids + [0]
        assert got[k] == (len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
    assert 50256 in tok.encode(texts[0], add_special_tokens=False).ids


# --- 7 SimHash ------------------------------------------------------------

def simhash_brute(text):
    import xxhash
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components_brute(fps, bits=2):
    fps = list(fps)
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_near_dup_components(request, which):
    from ampere.llm.simhash import near_dup_components
    df = request.getfixturevalue(which)
    src = df.select("doc_id", "text").collect()
    fps = [simhash_brute(r.text) for r in src]
    comp = components_brute(fps)
    least = {}
    for r, c in zip(src, comp):
        if r.doc_id is not None:
            least[c] = min(least.get(c, r.doc_id), r.doc_id)
    want = Counter((r.doc_id, f"{f:016x}", least.get(c)) for r, f, c in zip(src, fps, comp))
    assert Counter(map(tuple, near_dup_components(df).collect())) == want


def test_near_pairs_broadcast_no_cells(spark):
    from pyspark.sql import functions as F

    from ampere.llm.common import stored
    from ampere.llm.simhash import near_pairs
    fps = stored(spark.range(2000).select(F.xxhash64("id").alias("fp")), "test-fps")
    pairs = near_pairs(fps, 2)
    assert pairs.count() == 0          # the final plan is known now
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_near_pairs_by_chains_and_balls(spark, nothing):
    import random
    from ampere.llm.simhash import near_dup_components, near_pairs, segments_for
    rng = random.Random(3)
    fps = {0, (1 << 64) - 1}
    for _ in range(12):
        c = rng.getrandbits(64)
        fps.add(c)
        for _ in range(8):
            x = c
            for _ in range(rng.randint(1, 5)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    for bits, segments in ((1, 32), (2, 32), (3, 32), (2, 64), (2, 16), (2, 8), (2, None)):
        want = {(a, b) for a in fps for b in fps if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= bits}
        got = near_pairs(spark.createDataFrame([(x,) for x in fps], "fp long"), bits, segments).collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want
    # the more fingerprints, the finer the grid
    assert [segments_for(n) for n in (0, 10**4, 10**6, 10**9, 10**12)] == [8, 8, 16, 32, 64]
    for segments in (12, 128):
        with pytest.raises(ValueError):
            near_pairs(spark.createDataFrame([], "fp long"), 2, segments)
    assert near_dup_components(nothing).count() == 0


def test_components_of_a_long_chain(spark):
    from ampere.llm.common import components
    n = 200
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1000)], "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert all(got.get(i, i) == 0 for i in range(n + 1)) and got[1001] == 1000


def test_drop_near_copies_of_repeated_ids(spark):
    from ampere.llm.simhash import drop_near_copies
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(60)) for x in "abcd")
    data = [(1, a), (5, a + " "), (5, b), (7, b), (8, c), (8, c.upper()), (8, d), (9, d), (None, a)]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    out = drop_near_copies(df)
    assert out.columns == df.columns
    got = Counter((r.doc_id, r.text.lower()) for r in out.collect())
    assert got == Counter([(1, a), (5, b), (8, c), (8, d), (None, a)])


# --- 8 quality rules ------------------------------------------------------

def measures_brute(text):
    w = words(text)
    where = defaultdict(list)
    for i in range(len(w) - 4):
        where[tuple(w[i:i + 5])].append(i)
    covered = {p for v in where.values() if len(v) > 1 for i in v for p in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("which", ["docs", "odd", "nothing"])
def test_quality_measures(request, spark, which):
    from ampere.llm.quality_rules import apply_rules
    df = request.getfixturevalue(which)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in apply_rules(df, labels, stratum=F.col("lang")).collect())
    want = Counter()
    for r in df.select("doc_id", "text").collect():
        m = measures_brute(r.text)
        want[(r.doc_id, *m, m[0] < 10 or 100 * m[4] > 20 * m[0])] += 1
    assert got == want


def test_binomial_tail(spark):
    from ampere.llm.quality_rules import binomial_tail
    cases = [(n, x) for n in (0, 1, 50, 700, 5000) for x in (0, 1, 5, 40) if x <= n]
    df = spark.createDataFrame(cases, "n long, x long").select("n", "x", binomial_tail("n", "x", 0.01).alias("p"))
    for r in df.collect():
        if r.x >= r.n * 0.01:
            assert r.p == 1.0
        else:
            want = sum(math.comb(r.n, k) * 0.01**k * 0.99**(r.n - k) for k in range(r.x + 1))
            assert r.p == pytest.approx(want, rel=1e-9)


def test_certified_cutoffs_bound_false_rejections(spark):
    from ampere.llm.quality_rules import apply_rules
    import random
    rng = random.Random(5)
    data, labels = [], []
    for i in range(3000):
        bad = i % 6 == 0
        text = " ".join(f"word{rng.randrange(9999)}{'###' if bad and rng.random() < .9 or rng.random() < .002 else ''}" for _ in range(30))
        data.append((i, text, "rare" if i % 100 == 1 else "en"))
        labels += [(i, int(not bad)), (i, 1)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    got = apply_rules(df, spark.createDataFrame(labels, "doc_id long, quality int"), stratum=F.col("lang")).collect()
    bad = [r for r in got if r.doc_id % 6 == 0 and r.doc_id % 100 != 1]
    good = [r for r in got if r.doc_id % 6]
    assert sum(not r.kept for r in bad) > 0.95 * len(bad)
    assert sum(not r.kept for r in good) <= 0.05 * len(good)
    assert all(r.kept for r in got if r.doc_id % 100 == 1)  # too few labels to certify a cutoff there
    nolabels = apply_rules(df, spark.createDataFrame([], "doc_id long, quality int")).collect()
    assert all(r.kept != r.base_failed for r in nolabels)


# --- 9 mixing -------------------------------------------------------------

def targets_brute(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(3 * sizes[s] for s in fixed)
        t = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free} | {s: 3 * sizes[s] for s in fixed}
        over = {s for s in free if t[s] > 3 * sizes[s]}
        if not over:
            return t
        fixed |= over


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_mixing(request, which, monkeypatch):
    from ampere.llm import mixing
    df = request.getfixturevalue(which)
    monkeypatch.setattr(mixing, "ROWS_PER_RANGE", 7)
    got = mixing.mix_sources(df).collect()
    src = df.select("doc_id", "text", "source").collect()
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter((r.doc_id, r.source, len(words(r.text))) for r in src)
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r["size"] and abs(r.copies * r["size"] - r.taken) <= r["size"]
    want = targets_brute(dict(sizes))
    for r in got:
        assert r.target == pytest.approx(want[r.source], rel=1e-9) and r.source_size == sizes[r.source]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5 + 1e-6
    again = mixing.mix_sources(df.repartition(5)).collect()
    assert Counter((r.doc_id, r["size"], r.taken) for r in got) == Counter((r.doc_id, r["size"], r.taken) for r in again)


def test_mixing_prefers_quality_and_whole_epochs(spark, nothing):
    from ampere.llm.mixing import mix_sources, mixed_documents
    data = [(i, "a b c d", "big" if i < 900 else "small") for i in range(1000)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string").withColumn(
        "w", F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.1))
    got = mix_sources(df, weight=F.col("w")).collect()
    assert {r.taken for r in got if r.source == "small"} == {12}  # capped at three epochs
    even = sum(r.taken for r in got if r.source == "big" and r.doc_id % 2 == 0)
    assert even > 1.1 * sum(r.taken for r in got if r.source == "big" and r.doc_id % 2)
    out = mixed_documents(df, weight=F.col("w"))
    assert out.columns == df.columns and out.filter("source = 'small'").count() == 300
    assert mix_sources(nothing).count() == 0 and mixed_documents(nothing).count() == 0


def test_mixed_documents_by_row(spark):
    from ampere.llm.mixing import mix_sources, mixed_documents
    data = [(None if i % 3 == 0 else i // 10, f"t{i} " * (i % 4), "big" if i < 60 else "small") for i in range(100)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(3)
    out = mixed_documents(df)
    assert out.columns == df.columns
    got = Counter((r.source, r.doc_id is None, len(words(r.text))) for r in out.collect())
    want = Counter()
    for r in mix_sources(df).collect():
        if r.copies:
            want[(r.source, r.doc_id is None, r["size"])] += r.copies
    assert got == want and any(k[1] for k in got) and all(k[2] for k in got)
    weighted = mixed_documents(df, weight=F.length(df["text"]) + 1.0).collect()
    assert weighted and {r.text for r in weighted} <= {t for _, t, _ in data}


# --- 10 suffix dedup ------------------------------------------------------

def repeats_brute(texts, length):
    seen = defaultdict(int)
    for b in texts:
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] += 1
    out = []
    for b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_order():
    import random
    from ampere.llm.suffix_dedup import suffix_order
    rng = random.Random(1)
    cases = [[b"banana"], [b"aaaa", b"aa"], [b""], [b"abab", b"", b"ba"], [bytes(range(50)), bytes(range(50, 0, -1))]]
    cases += [[bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 5))] for _ in range(60)]
    for strings in cases:
        got = [strings[c][i:] for c, i in suffix_order(strings)]
        assert got == sorted(s[i:] for s in strings for i in range(len(s)))


@pytest.mark.parametrize("which", ["docs", "odd", "nothing"])
def test_remove_repeats(request, which):
    from ampere.llm.suffix_dedup import remove_repeats
    df = request.getfixturevalue(which)
    src = [(r.doc_id, (r.text or "").encode()) for r in df.select("doc_id", "text").collect()]
    want = Counter((i, *w) for (i, _), w in zip(src, repeats_brute([b for _, b in src], 200)))
    assert Counter(map(tuple, remove_repeats(df).collect())) == want


@pytest.mark.parametrize("rows_in_a_task", [2000, 1])
def test_remove_repeats_mixed_contexts(spark, rows_in_a_task, monkeypatch):
    """Passages around the length in many surroundings, edits, periods, overlaps in one document."""
    import random
    from ampere.llm import suffix_dedup as S
    monkeypatch.setattr(S, "GROUP_ROWS", rows_in_a_task)
    monkeypatch.setattr(S, "SLICE", 4000)
    rng = random.Random(11)
    rand = lambda n: "".join(rng.choice("abcdefgh \n") for _ in range(n))
    long, texts = rand(3000), []
    for n in (190, 199, 200, 201, 230, 260, 400):
        p = rand(n)
        texts += [rand(rng.randint(0, 300)) + p + rand(rng.randint(0, 300)) for _ in range(4)]
    for _ in range(8):
        t = list(long)
        for _ in range(rng.randint(1, 6)):
            t[rng.randrange(len(t))] = "#"
        texts.append("".join(t))
    texts += ["xyz" * 400, rand(250) * 3, rand(9000), long[500:900] + rand(50) + long[500:900], rand(199), rand(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = {i: w for i, w in enumerate(repeats_brute([t.encode() for t in texts], 200))}
    got = {r.doc_id: tuple(r)[1:] for r in S.remove_repeats(df, gram=64 if rows_in_a_task == 1 else S.GRAM).collect()}
    assert got == want


# --- pipeline -------------------------------------------------------------

def test_pipeline_stages_against_brute_force(spark, docs):
    import corpus_pipeline as P
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    cur, kept = docs, {}
    for name, f in P.STAGES[:-1]:
        cur = f(spark, cur, SMALL).cache()
        assert cur.columns == docs.columns
        kept[name] = cur.collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id for r in labels.filter("toxic = 1").collect()}
    assert not toxic & {r.doc_id for r in kept["toxicity"]}
    clean = {r.doc_id for r in labels.filter("toxic = 0").collect()}
    assert clean <= {r.doc_id for r in kept["toxicity"]}
    exact = {}
    for r in sorted(kept["toxicity"], key=lambda r: r.doc_id):
        exact.setdefault(BLANK.sub(" ", r.text or ""), r.doc_id)
    assert sorted(r.doc_id for r in kept["exact_dedup"]) == sorted(exact.values())
    ids = sorted(exact.values())
    comp = components_brute([simhash_brute(text[i]) for i in ids])
    first = {}
    for i, c in zip(ids, comp):
        first[c] = min(first.get(c, i), i)
    assert sorted(r.doc_id for r in kept["simhash_near_dedup"]) == sorted(first.values())
    n = Counter(r.doc_id for r in kept["mixing"])
    assert set(n) <= set(first.values()) and max(n.values()) <= 3
    out = P.run(spark, SMALL).collect()
    total = Counter()
    for r in out:
        total[r.doc_id] += 1 if r.piece == 0 else 0
    assert total == n


def test_pipeline_takes_odd_rows(spark, odd, nothing):
    import corpus_pipeline as P
    for start in (odd, nothing):
        cur = start
        for _, f in P.STAGES:
            cur = f(spark, cur, SMALL)
            cur.count()


def test_pipeline_keeps_rows_of_null_ids(spark, odd):
    import corpus_pipeline as P
    stages = dict(P.STAGES)
    before = P.near_dedup(spark, P.exact_dedup(spark, odd, SMALL), SMALL).cache()
    out = stages["mixing"](spark, before, SMALL).collect()
    sized = {(r.doc_id, r.text) for r in before.collect() if words(r.text)}
    assert {(r.doc_id, r.text) for r in out} <= sized
    assert (None, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau. ") in sized
    assert any(r.doc_id is None for r in out)


# --- caps that are gone ------------------------------------------------------

def test_every_language_is_learned(spark):
    """More languages than one batch has rows; each has words of its own."""
    from ampere.llm.language_id import fit_language_id, identify_language
    langs = [f"x{k:02d}" for k in range(90)]
    letters = "abcdefghijklmnopqrstuvwxyz"
    stem = {v: "".join(letters[(7 * k + j * (k % 5 + 1) + k // 26) % 26] for j in range(5)) for k, v in enumerate(langs)}
    rows = [(100 * k + i, f"{stem[v]} {stem[v]}{letters[i]} {letters[i]}{stem[v]}", v) for k, v in enumerate(langs) for i in range(26)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit_language_id(df)
    assert model.langs == langs
    assert len(fit_language_id(df, max_rows=20).langs) == 90      # the bound is on rows: one of each stays
    got = identify_language(df, model).join(df, "doc_id").where("lang = lang_pred").count()
    assert got > 0.6 * len(rows)


def test_language_ties_and_repeated_rows(spark):
    from ampere.llm.language_id import fit_language_id, identify_language
    rows = [(1, "guten tag", "de"), (1, "guten tag", "de"), (2, "good day", "en"), (None, "good day", "en"), (3, "123", "fr"), (4, None, "es")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    a, b = fit_language_id(df), fit_language_id(df.repartition(5))
    assert a.langs == ["de", "en"] and (a.table == b.table).all()
    assert identify_language(df, a).count() == 6


def test_refinement_hashes_survivors_only(spark):
    """Prefixes are taken of rows with a repeated length, digests of rows with a repeated prefix."""
    from pyspark.sql import functions as F

    from ampere.llm.exact_dedup import exact_groups, surviving_groups
    from ampere.llm.common import one_space
    texts = ["a", "bb", "cc", "dd dd", "ddddd", "x" * 200 + "1", "x" * 200 + "2", "bb"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = {r.n_bytes for r in surviving_groups(df, one_space(F.col("text"))).collect()}
    assert groups == {2, 201}
    got = {r.doc_id: r for r in exact_groups(df).collect()}
    assert [k for k, r in got.items() if r.text_sha256 is not None] and got[0].text_sha256 is None and got[3].text_sha256 is None
    assert got[1].group_size == 2 and not got[7].kept and got[5].kept and got[6].kept


def test_toxicity_matches_equal_brute_force():
    """Whole-word and stem matches of random texts, against a word-by-word reading."""
    import random

    from ampere.llm.toxicity import ToxicityModel
    rng = random.Random(3)
    entries = {"abc": 1.0, "bca*": 2.0, "cab": 4.0, "acc*": 8.0}
    m = ToxicityModel(entries, exceptions=())
    a = m.automaton()
    for _ in range(600):
        text = "".join(rng.choice("abc  .,") for _ in range(rng.randrange(40)))
        hits = [x for w in re.findall("[abc]+", text) for e, x in entries.items()
                if w == e or (e.endswith("*") and w.startswith(e[:-1]))]
        assert m.matches(a, text) == (sum(hits), len(hits)), text


def test_lexicon_cover_equals_a_plain_one_and_takes_any_number_of_entries():
    """The incremental greedy cover against one that counts all gains anew, with more than a thousand entries."""
    import random

    import numpy as np

    from ampere.llm.toxicity import COVER, MIN_GAIN, _cover

    def plain(held, entries, weight):
        need, left = [COVER] * len(held), [set(k) for k in held]
        stems, chosen = [e.rstrip("*") for e in entries], []
        while any(n > 0 for n in need):
            gain = np.array([sum(j in k for k, n in zip(left, need) if n > 0) for j in range(len(entries))])
            j = int(np.argmax(gain * weight))
            if gain[j] < max(1, MIN_GAIN * len(held)):
                break
            chosen.append(j)
            kin = {k for k, s in enumerate(stems) if s.startswith(stems[j]) or stems[j].startswith(s)}
            for t, k in enumerate(held):
                if j in k:
                    need[t] -= j in left[t]
                    left[t] = left[t] - kin
        return chosen

    rng = random.Random(8)
    for n_entries, n_texts in ((12, 40), (1500, 60), (3, 0)):
        words = ["".join(rng.choice("ab") for _ in range(rng.randrange(2, 7))) + rng.choice(["", "*"]) for _ in range(n_entries)]
        held = [sorted(rng.sample(range(n_entries), rng.randrange(0, min(9, n_entries)))) for _ in range(n_texts)]
        weight = np.array([rng.choice([1.0, 2.0, 3.5]) for _ in words])
        assert _cover(held, words, weight) == plain(held, words, weight)


def test_html_keeps_sentences_whole():
    from ampere.llm.html_extract import main_text
    text = lambda s: main_text(s, set())
    assert text("<article><p>Euler: <math><mi>e</mi></math> is it</p></article>") == "Euler: e is it"
    assert text("<article><p>The <span class='share'>share of voters</span> rose.</p></article>") == "The share of voters rose."
    assert text("<article><p>Go <b>on</b></p><span class='share'>Share this</span></article>") == "Go on"
    assert text("<article><p>Go <span class='ad' hidden>hidden</span> on</p></article>") == "Go on"
    assert text("<article><h1>Title</h1><p>Body.</p><label>A label</label></article>") == "Title\n\nBody.\n\nA label"


def test_html_paths_tell_classes_apart_and_stay_short():
    from ampere.llm.html_extract import MAX_DEPTH, Page
    page = Page("<div class='w-1/2'><p>a</p></div><div class='w-1/3'><p>b</p></div><div class='w-1%2F3'><p>c</p></div>")
    paths = [p for p, _, _ in page.blocks]
    assert len(set(paths)) == 3 and all(p.count("/") == 2 for p in paths)
    deep = Page("<div class='c'>w " * 30_000)
    assert len(deep.blocks) == 30_000 and max(p.count("/") for p, _, _ in deep.blocks) == MAX_DEPTH
