"""Winnowing, SimHash, chat, HTML, Kneser-Ney and the hidden Markov model."""

import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from martforge.llm import chat, hmm, html_extract, kneser_ney, simhash, winnowing, wordhash
from martforge.llm.common import low_keys, lowest
from martforge.llm.components import connected_components
from tests.llm import brute
from tests.llm.frames import DOCS, docs, parquet


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    return parquet(docs(spark), str(tmp_path_factory.mktemp("docs") / "d"))


@pytest.fixture(scope="module")
def empty(spark):
    return docs(spark, [])


# --- hashing and winnowing

def test_word_hashes_do_not_depend_on_place_or_piece(monkeypatch):
    words = [b"a", b"aa", "é".encode(), b"x" * 300, b"longer-word", b"a"] * 50
    norm = b" ".join(words)
    whole = wordhash.word_hashes(norm)
    monkeypatch.setattr(wordhash, "PIECE", 64)
    assert (whole == wordhash.word_hashes(norm)).all()
    assert len(set(whole.tolist())) == 5 and whole[0] == whole[5]
    assert len(wordhash.word_hashes(b"")) == 0


def test_winnowing_keeps_a_print_in_every_span():
    rng = random.Random(2)
    words = np.array([rng.randrange(6) for _ in range(500)], np.uint64)
    for span in range(1, 11):
        at, hashes = winnowing.kept(words, span)
        k = (span + 1) // 2
        for s in range(len(words) - span + 1):
            inside = [h for p, h in zip(at, hashes, strict=True) if s <= p <= s + span - k]
            alone = winnowing.kept(words[s:s + span], span)[1]
            assert len(alone) == 1 and alone[0] in inside


BENCH = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short one"), (3, None), (4, ""),
         (None, "the cat sat on the mat and the dog lay"), (6, "cat sat on the mat and the dog lay by the door"),
         (60, "cat sat on the mat and the dog lay by the door"), (7, "a a a a a a a a a a a")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 64])
def test_contamination(spark, awkward, empty, block_bytes):
    rng = random.Random(4)
    texts = {1000 + i: " ".join(rng.choice(["alpha beta gamma delta epsilon zeta eta theta iota kappa", "SHORT, one",
                                           "lambda mu", "noise", "a a a a a a a", "lambda"]) for _ in range(8)) for i in range(60)}
    rows = [(i, t, "en", "s", 0) for i, t in texts.items()]
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    given = awkward.unionByName(docs(spark, rows))
    got = Counter(tuple(r) for r in winnowing.decontamination_report(given, bench, block_bytes).collect())
    want = Counter()
    for doc_id, text, *_ in [*DOCS, *rows]:
        n, hit, ids = brute.contamination(text, BENCH)
        want[doc_id, n, hit, len(ids), brute.sha(",".join(ids)), hit > 0] += 1
    assert got == want
    assert winnowing.decontamination_report(empty, bench).collect() == []
    assert [len(b) for b in winnowing.benchmark_blocks(bench.union(bench))] == [len(BENCH)]
    assert winnowing.decontaminate(awkward, bench.limit(0)).count() == len(DOCS)
    clean = winnowing.decontaminate(given, bench, block_bytes)
    assert clean.columns == given.columns and clean.count() == sum(n for k, n in want.items() if not k[-1])


# --- SimHash

def test_near_lanes_find_exactly_the_close_ones():
    rng = np.random.default_rng(0)
    prints = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    prints[100:200] = prints[:100] ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64))
    prints[200:] = prints[100:200] ^ np.uint64(0b101) ^ (np.uint64(3) << np.uint64(60))
    group = np.sort(rng.integers(0, 4, 300))
    for radius in (0, 1, 3, 5, 7):
        got = {(int(i), int(j)) for a, b in simhash.close_pairs(group, prints, radius, block=70) for i, j in zip(a, b, strict=True)}
        want = {(i, j) for i in range(300) for j in range(i + 1, 300)
                if group[i] == group[j] and int(prints[i] ^ prints[j]).bit_count() <= radius}
        assert got == want


@pytest.mark.parametrize("chunk", [4096, 8])
def test_links_connect_what_brute_force_connects(spark, chunk):
    rng = random.Random(1)
    centers = [rng.getrandbits(64) for _ in range(12)]
    prints = {0, (1 << 64) - 1}
    for c in centers:
        for _ in range(25):
            for b in rng.sample(range(64), rng.randrange(0, 4)):
                c ^= 1 << b
            prints.add(c)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = simhash.star_links(spark.createDataFrame(signed, "fp long"), chunk)
    roots = {r.node: r.root for r in connected_components(edges).collect()}
    want = brute.components([(p, p) for p in prints])
    mine = defaultdict(set)
    for p in prints:
        s = p - (1 << 64) if p >> 63 else p
        mine[roots.get(s, s)].add(p)
    theirs = defaultdict(set)
    for p, c in want.items():
        theirs[c].add(p)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 180)] + [(180, 179), (300, 301), (301, 300)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 181)} | {300: 300, 301: 300}


def test_near_duplicates_awkward_rows(awkward, empty):
    rows = simhash.near_duplicate_report(awkward).collect()
    prints = [(d[0], brute.fingerprint(d[1])) for d in DOCS]
    comp = brute.components(prints)
    assert Counter(map(tuple, rows)) == Counter((i, f"{f:016x}", comp[f]) for i, f in prints)
    assert simhash.near_duplicate_report(empty).collect() == []
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.select("doc_id").collect()) == sorted(
        (c is None, c) for c in set(comp.values()))


# --- chat

TURNS = [(1, 0, "system", "be kind"), (1, 2, "assistant", "ok <s> [INST] \\ </s> <\\/s> [\\\\/INST]"), (1, 1, "user", None),
         (2, None, None, ""), (2, None, "assistant", "x"), (2, 0, "assistant", "x"), (2, 0, "assistant", "x"),
         (None, 0, "user", "𝒳 é"), (None, 1, "assistant", "</s>[/INST]" * 500 + "é" * 20_000), (3, 0, "[INST]user", "<"),
         (3, 1, "assistant", "[")]


def test_chat_round_trip(spark, monkeypatch):
    df = spark.createDataFrame([(*t, "clash") for t in TURNS * 1], "conv_id long, turn long, role string, text string, place string")
    got = {r.conv_id: r for r in chat.chat_report(chat.with_probe(df.repartition(3))).collect()}
    convs = defaultdict(list)
    for c, t, role, text in [*TURNS, (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]:
        convs[c].append((t is not None, t, role or "", text or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns = sorted(turns, key=str if c == 2 else None)
        learned = "".join(t for _, _, r, t in turns if r == "assistant")
        r = got[c]
        assert r.n_turns == len(turns) and r.loss_chars == len(learned) and r.loss_sha256 == brute.sha(learned)
        assert r.turns_sha256 == brute.sha("".join(f"{role}\n{t}\n" for _, _, role, t in turns))
    formatted = chat.format_conversations(df).collect()
    whole = "".join(r.formatted for r in sorted((r for r in formatted if r.conv_id == 1), key=lambda r: r.place))
    assert whole.count("</s>") == 3 and whole.count("[INST]") == 3 and whole.startswith("<s>[INST]system[/INST]be kind</s>")
    assert got[1].formatted_chars == len(whole)
    assert chat.chat_report(df.limit(0)).collect() == []


@pytest.mark.parametrize("text", ["".join(p) for p in product(["<", "\\", "/s>", "[", "INST]"], repeat=4)][::7])
def test_escapes_are_undone(text):
    import pyarrow as pa

    once = chat.escaped(pa.array([text]))[0].as_py()
    assert chat.unescaped(once) == text
    assert not re.search(r"<s>|</s>|\[INST\]|\[/INST\]", once)


# --- HTML

PAGE = ("<html><head><title>T t</title><style>p{}</style><script>var t='</p>';</script></head><body><header>Site head</header>"
        "<nav><ul><li><a href='/a>b'>Home</a></li></ul></nav><div class='ad'>Buy now cheap cheap cheap</div>"
        "<article><h1>Big  title</h1><p>Some <b>bold</b>er text &amp; more<br>here.<p>Second block of words, long enough."
        "<form><p>Your name please</p></form><aside>Look aside</aside><p>Third &lt;block&gt;.</p></article>"
        "<div id=\"comments\"><p>I like this very much, said a reader of the page, twice or more.</p></div>"
        "<footer>&copy; foot</footer></body></html>")
MAIN = "Big title Some bolder text & more here. Second block of words, long enough. Third <block>."


def test_main_text(spark):
    cut = PAGE[:PAGE.index("Third")]
    rows = [(1, "u", PAGE), (2, "u", None), (3, "u", ""), (4, "u", cut), (5, "u", "<p>only <p>words"), (6, "u", "<<< & <p"),
            (None, None, PAGE), (1, "u", PAGE), (7, "u", "<div>" * 20_000 + "deep words here" + "</div>" * 10), (8, "u", "plain words")]
    rows += [(100 + i, "u", PAGE) for i in range(20)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = defaultdict(list)
    for r in html_extract.extract(df).collect():
        assert r.n_chars == len(r.text)
        got[r.page_id].append(r.text)
    assert got[1] == [MAIN, MAIN] and got[None] == [MAIN] and got[119] == [MAIN]
    assert got[2] == [""] and got[3] == [""]
    assert got[4] == [MAIN[:MAIN.index(" Third")]]
    assert got[5] == ["only words"] and got[7] == ["deep words here"] and got[8] == ["plain words"]
    assert html_extract.extract(df.limit(0)).collect() == []


@pytest.mark.parametrize("wrapper", ["class='layout has-sidebar'", "class=no-comments", "class='with-header'", "id=form-page",
                                     "class='layout sidebar'", "data-id='related'", "data-role=banner",
                                     "title='see class=comments'", "onclick=\"go('/p?id=7-related')\""])
def test_the_article_wins_over_its_wrapper(wrapper):
    page = f"<body><nav>Home</nav><div {wrapper}><article><p>Some words of the page.</p></article></div></body>"
    assert html_extract.main_text(page, html_extract.Weights({})) == "Some words of the page."
    if "'layout sidebar'" not in wrapper:  # also when no markup names the content
        page = page.replace("article", "section")
        assert html_extract.main_text(page, html_extract.Weights({})) == "Some words of the page."


def test_attributes_are_read_whole():
    weights = html_extract.Weights({})
    for link in ("<a href='/p?id=7-related'>", "<a href=/p?id=related>", "<a data-id=related>", "<a title=\"a id=related b\">"):
        assert html_extract.main_text(f"<p>See {link}this page</a> too", weights) == "See this page too"
    for mark in ("class='x related'", "ID=related", "a=b class = 'Related' c", "role=navigation", "data-id='7' id=\"comments\""):
        assert html_extract.main_text(f"<p>Words <b {mark}>left out</b> stay", weights) == "Words stay"


def test_marked_parts_inside_an_article_stay_out():
    weights = html_extract.Weights({})
    for inner in ("<div class=comments><article>a reply</article></div>", "<aside><article>aside</article></aside>",
                  "<div class='related'><p>see also</p></div>"):
        assert html_extract.main_text(f"<article><p>Some words of the page.</p>{inner}</article>", weights) == "Some words of the page."
    for outer in ("<nav><article>a menu</article></nav>", "<div id=comments><article class='comment'>a reply</article></div>"):
        assert html_extract.main_text(outer, weights) == ""


LEARNED = {"t:p": (900, 0), "t:/p": (900, 0), "w:p": (9000, 3), "t:div": (0, 40), "t:/div": (0, 40), "w:div": (1, 60)}


@pytest.mark.parametrize("markup, text", [
    ("<table>" + "".join(f"<tr><td>a{i}</td><td>b{i}</td></tr>" for i in range(20)) + "</table>",
     " ".join(f"a{i} b{i}" for i in range(20))),
    ("<ul>" + "".join(f"<li>x{i}" for i in range(20)) + "</ul>", " ".join(f"x{i}" for i in range(20))),
    ("<details><summary>In short</summary>and at length</details>", "In short and at length"),
    ("<figure><img src=x><figcaption>A caption</figcaption></figure>", "A caption"),
    ("<section><div><div>one</div></div></section><section><div><div>two</div></div></section>", "one two"),
    ("<x-card><x-row>own elements</x-row></x-card>", "own elements"),
    ("<p>Energy <math><mi>E</mi><mo>=</mo><mi>mc</mi></math> holds.</p>", "Energy E=mc holds."),
    ("<p>&#" + "9" * 6000 + ";&#" + "0" * 6000 + "65;&#x41;&#65b;</p>", "\ufffdAAAb;")])
def test_an_article_is_kept_whole(markup, text):
    for weights in (html_extract.Weights({}), html_extract.Weights(dict(LEARNED))):
        words = "<p>Some words of the page.</p>"
        assert html_extract.main_text(f"<article>{words}{markup}</article>", weights) == f"Some words of the page. {text}"
        assert html_extract.main_text(f"<div>out</div><article>{markup}{words}</article>", weights) == f"{text} Some words of the page."


def test_lists_and_tables_stay_without_labelled_content():
    weights = html_extract.Weights({})
    for row in ("<li>item {}</li>", "<table><tr><td>cell {}</td></tr></table>", "<dl><dt>term {}</dt></dl>"):
        rows = "".join(row.format(i) for i in range(9))
        page = f"<nav><a href=/>Home</a></nav><section><p>Some words of the page.</p>{rows}</section><footer>foot</footer>"
        name = row.split(" {")[0].split(">")[-1]
        assert html_extract.main_text(page, weights) == " ".join(["Some words of the page.", *(f"{name} {i}" for i in range(9))])


def test_what_is_no_article_stays_out():
    weights = html_extract.Weights(dict(LEARNED))
    page = "<article><p>Some words of the page.</p>{}</article>{}"
    for name in ("ad-slot", "comment-list", "user-comments", "user-replies", "x sidebar_ad", "post-comments"):
        part = f"<div class='{name}'><p>Buy or say this, with many more words than all of the page.</p></div>"
        for inner, after in ((part, ""), ("", part)):
            assert html_extract.main_text(page.format(inner, after), weights) == "Some words of the page."
    two = "<article><p>One.</p></article><div><p>Filler between the two, long enough to win.</p></div><article>Two.</article>"
    assert html_extract.main_text(two, weights) == "One. Two."
    assert html_extract.main_text(two + "<div class=related><article>Another story.</article></div>", weights) == "One. Two."
    assert html_extract.main_text("<article></article><p>Only words here.</p>", weights) == "Only words here."


@pytest.mark.parametrize("broken", ["<p", "<p ", "<b>{}<div></div>", "<p><b>{}<div>x</div>", "<a b=\">\"", "<a b='>\">", "</p",
                                    "<a href='x", "<li>{}<div></li>", "<!--", "&#", "<a b=", "< "])
def test_broken_pages_take_linear_time(broken):
    def taken(n: int) -> float:
        page = "".join(part * n for part in broken.split("{}"))
        times = []
        for _ in range(3):
            at = time.perf_counter()
            html_extract.main_text(page, weights)
            times.append(time.perf_counter() - at)
        return min(times)

    weights = html_extract.Weights({})
    assert taken(32_000) < 20 * taken(4_000) + 0.05  # eight times the page; quadratic would be 64


def test_best_run_is_the_maximum():
    rng = random.Random(0)
    for _ in range(300):
        s = [rng.randrange(-5, 6) for _ in range(rng.randrange(0, 12))]
        lo, hi = html_extract.best_run(s)
        assert sum(s[lo:hi]) == max([0, *(sum(s[a:b]) for a in range(len(s)) for b in range(a + 1, len(s) + 1))])


# --- Kneser-Ney

def test_kneser_ney_is_a_distribution(spark):
    rng = random.Random(0)
    vocabulary = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(30)], k=rng.randrange(1, 40))) for _ in range(200)]
    model = kneser_ney.KneserNey(spark.createDataFrame([(t,) for t in texts], "text string"))
    for context in (["w0", "w1"], ["w3", "zzz"], ["never", "seen"]):
        total = 0.0
        for w in [*vocabulary, "new"]:
            s = kneser_ney.sequence(" ".join([*context, w]))
            p = 10 ** (model.log10([s[:-1]])[1][0] - model.log10([s[:-2]])[1][0])
            total += p
        s = kneser_ney.sequence(" ".join(context))
        total += 10 ** (model.log10([s])[1][0] - model.log10([s[:-1]])[1][0])
        assert total == pytest.approx(1, abs=1e-4)


def brute_kneser_ney(texts):
    """log10 probability of a text, from dictionaries over all ``texts``."""
    def grams(text):
        w = ["<s>", "<s>", *text.lower().split(), "</s>"]
        return [tuple(w[i:i + 3]) for i in range(len(w) - 2)]

    tri = Counter(g for t in texts for g in grams(t))
    bi = Counter(g[1:] for g in tri)
    uni = Counter(g[1:] for g in bi)

    def cut(counts):
        n1, n2, n3, n4 = (sum(c == k for c in counts.values()) + 0.5 for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        d = [min(max(x, 0.1), k - 0.05) for x, k in ((1 - 2 * y * n2 / n1, 1), (2 - 3 * y * n3 / n2, 2), (3 - 4 * y * n4 / n3, 3))]
        return lambda c: d[min(c, 3) - 1]

    levels = []
    for counts in (bi, tri):
        of, total, left = cut(counts), Counter(), Counter()
        for g, c in counts.items():
            total[g[:-1]] += c
            left[g[:-1]] += of(c)
        levels.append((counts, of, total, left))
    of1, n = cut(uni), sum(uni.values())
    unknown = sum(of1(c) for c in uni.values()) / n / (len(uni) + 1)

    def log10(text):
        found = 0.0
        for g in grams(text):
            p = unknown + ((uni[g[2:]] - of1(uni[g[2:]])) / n if g[2:] in uni else 0)
            for (counts, of, total, left), key in zip(levels, (g[1:], g), strict=True):
                if t := total[key[:-1]]:
                    p = (counts[key] - of(counts[key]) if key in counts else 0) / t + left[key[:-1]] / t * p
            found += math.log10(p)
        return found
    return log10


def test_kneser_ney_trains_on_every_trusted_text(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "RANGE_ENTRIES", 1000)
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices([f"w{j}" for j in range(60)], [1 / (j + 1) for j in range(60)], k=rng.randrange(0, 12))), "en")
            for i in range(3600)] + [(3600, None, None), (3601, "never seen", "en"), (3602, "w0 " * 300_000 + "last words", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    labels = spark.createDataFrame([(i, 1, 0) for i in [*range(3500), 3602]], "doc_id long, quality int, toxic int")
    held = {r[0] for r in labels.filter("pmod(xxhash64(doc_id), 5) = 0").select("doc_id").collect()}
    trusted = [t for i, t, _ in rows if (i < 3500 or i == 3602) and i not in held]
    assert len(trusted) > 2000
    log10 = brute_kneser_ney(trusted)
    got = {r.doc_id: r for r in kneser_ney.quality_scores(df, labels).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows[::7] + rows[-3:]:
        assert got[i].n_tokens == len((t or "").split()) + 1
        assert got[i].log10_prob == pytest.approx(log10(t or ""), rel=1e-4, abs=1e-5)


def test_training_takes_one_text_of_an_id(spark):
    rows = [(1, "same"), (1, "same"), (2, "one"), (2, "other"), (3, None), (None, "null id"), (4, "untrusted")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'en' AS lang").repartition(3)
    ids = spark.createDataFrame([(1,), (2,), (3,), (None,)], "doc_id long")
    got = sorted(r.text for r in kneser_ney.training_texts(kneser_ney.blocks_of(df), ids).collect())
    assert len(got) == 2 and got[-1] == "same" and got[0] in ("one", "other")


def test_quality_scores_write_less_than_the_texts(spark, monkeypatch, tmp_path):
    """All that a run of several passes writes to the shared folder, and its result."""
    monkeypatch.setattr(kneser_ney, "PASS_TOKENS", 1 << 16)
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 9))) for _ in range(20_000)]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = [(i, " ".join(rng.choices(words, weights, k=300)), "en") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(600)], "doc_id long, quality int, toxic int")
    monkeypatch.setattr("martforge.session.shared_dir", lambda _, label: f"file://{tmp_path}/{label}")
    got = {r.doc_id: r for r in kneser_ney.quality_scores(df, labels).collect()}
    assert sum(f.stat().st_size for f in tmp_path.rglob("*.parquet")) < 0.8 * sum(len(t) for _, t, _ in rows)
    held = {r[0] for r in labels.filter("pmod(xxhash64(doc_id), 5) = 0").select("doc_id").collect()}
    log10 = brute_kneser_ney([t for i, t, _ in rows if i not in held])
    for i, t, _ in rows[::40]:
        assert got[i].log10_prob == pytest.approx(log10(t), rel=1e-5)


def test_quality_scores(spark, awkward, empty):
    rng = random.Random(1)
    good = [(i, " ".join(rng.choice(["the cat sat", "a dog lay", "on the mat", "by the door"]) for _ in range(20)), "en", "s", 0)
            for i in range(5000, 5200)]
    bad = [(i, " ".join("".join(rng.choices("qxzjk", k=6)) for _ in range(60)), "en", "s", 0) for i in range(6000, 6020)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(5000, 5150) for _ in range(2)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    given = awkward.unionByName(docs(spark, good + bad))
    got = defaultdict(list)
    for r in kneser_ney.quality_scores(given, labels).collect():
        got[r.doc_id].append(r)
    assert all(got[d[0]][0].kept for d in good) and not any(got[d[0]][0].kept for d in bad)
    assert got[1][0].kept and got[2][0].kept and sum(map(len, got.values())) == len(DOCS) + 220
    assert all(r.kept for r in kneser_ney.quality_scores(awkward, labels.limit(0)).collect())
    assert kneser_ney.quality_scores(empty, labels).collect() == []


def test_trusted_texts_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "MAX_TEXT_BYTES", 50)
    rows = [(i, "t" * 10) for i in range(20)] + [(0, "a" * 10)] * 30 + [(20, "x" * 51), (21, None), (None, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ids = df.select("doc_id").distinct()
    got = {r.doc_id: r.text for r in kneser_ney.trusted_texts(df, ids).collect()}
    assert got == {0: "a" * 10} | {i: "t" * 10 for i in range(1, 20)}
    assert kneser_ney.trusted_texts(df, ids, 75).count() == 7


# --- hidden Markov model

def toy(seed=0, states=3, classes=5):
    rng = np.random.default_rng(seed)
    return hmm.Model(rng.dirichlet(np.ones(states)), rng.dirichlet(np.ones(states), states), rng.dirichlet(np.ones(classes), states).T)


def test_forward_is_exact():
    m, rng = toy(), np.random.default_rng(1)
    seqs = [rng.integers(0, 5, n).astype(np.uint16) for n in (1, 2, 5, 3, 5)]
    for seq, got in zip(seqs, hmm.log_likelihoods(m, seqs), strict=True):
        total = sum(m.start[p[0]] * np.prod([m.move[a, b] for a, b in zip(p, p[1:], strict=False)])
                    * np.prod([m.emit[c, s] for c, s in zip(seq, p, strict=True)]) for p in product(range(3), repeat=len(seq)))
        assert 10 ** got == pytest.approx(total)


def test_long_texts_score_alike(monkeypatch):
    m, rng = toy(), np.random.default_rng(4)
    seqs = [rng.integers(0, 5, n).astype(np.uint16) for n in (1, 7, 8, 9, 16, 17, 33, 100)]
    want = hmm.log_likelihoods(m, seqs)
    monkeypatch.setattr(hmm, "LONG", 8)
    monkeypatch.setattr(hmm, "STRETCH", 5)
    assert np.allclose(hmm.log_likelihoods(m, seqs), want, rtol=1e-12)


def test_expected_counts_are_exact():
    m, rng = toy(), np.random.default_rng(2)
    seqs = [rng.integers(0, 5, n).astype(np.uint16) for n in (4, 1, 3)]
    start, move, emit, total = hmm.expected_counts(m, seqs)
    s, a, e, ll = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3)), 0.0
    for seq in seqs:
        paths = list(product(range(3), repeat=len(seq)))
        w = np.array([m.start[p[0]] * np.prod([m.move[x, y] for x, y in zip(p, p[1:], strict=False)])
                      * np.prod([m.emit[c, k] for c, k in zip(seq, p, strict=True)]) for p in paths])
        ll += np.log10(w.sum())
        for p, q in zip(paths, w / w.sum(), strict=True):
            s[p[0]] += q
            for x, y in zip(p, p[1:], strict=False):
                a[x, y] += q
            for c, k in zip(seq, p, strict=True):
                e[c, k] += q
    assert start == pytest.approx(s, rel=1e-4) and move == pytest.approx(a, rel=1e-4)
    assert emit == pytest.approx(e, rel=1e-4, abs=1e-6) and total == pytest.approx(ll, rel=1e-5)


def test_start_leaves_out_long_texts(spark, monkeypatch):
    monkeypatch.setattr(hmm, "INIT_TOKENS", 2)
    given = [(1, [False], [2], bytearray(np.array([1, 2], np.uint16).tobytes())),
             (2, [False, True], [9, 1], bytearray(np.arange(10, dtype=np.uint16).tobytes()))]
    used = []
    monkeypatch.setattr(hmm, "first_model", lambda seqs, overall, first=hmm.first_model: used.extend(seqs) or first(seqs, overall))
    texts = spark.createDataFrame(given, "block long, held_out array<boolean>, n array<long>, seq binary")
    hmm.train(texts, np.full(hmm.CLASSES, 1 / hmm.CLASSES), rounds=1)
    assert [s.tolist() for s in used] == [[1, 2]]


def test_training_raises_likelihood(spark):
    rng = np.random.default_rng(0)
    truth = toy(5, classes=hmm.CLASSES)
    overall = np.full(hmm.CLASSES, 1 / hmm.CLASSES)
    rows = []
    for i in range(40):
        state, seq = rng.choice(3, p=truth.start), []
        for _ in range(200):
            seq.append(rng.choice(hmm.CLASSES, p=truth.emit[:, state]))
            state = rng.choice(3, p=truth.move[state])
        rows.append((i, [False], [len(seq)], bytearray(np.array(seq, np.uint16).tobytes())))
    texts = spark.createDataFrame(rows, "block long, held_out array<boolean>, n array<long>, seq binary")
    _, seen = hmm.train(texts, overall, rounds=4)
    assert seen == sorted(seen)


def test_scores_awkward_rows(awkward, empty, monkeypatch):
    monkeypatch.setattr(hmm.Vocabulary.__init__, "__defaults__", (20,))  # most words take the join
    n, v, want = brute.unigrams([(d[0], d[1]) for d in DOCS])
    rows = hmm.score_report(awkward).collect()
    key = lambda h, t, k, b: (h, t, k, round(b, 6))
    assert Counter((r.doc_id, *key(r.held_out, r.n_tokens, r.n_known, r.base_score)) for r in rows) == Counter(
        (d[0], *key(*w)) for d, w in zip(DOCS, want, strict=True))
    assert {r.train_tokens for r in rows} == {n}
    assert all(np.isfinite(r.score) and r.score < 0 for r in rows)
    assert hmm.score_report(empty).collect() == []


def test_word_given_class_sums_to_one(awkward):
    from martforge.llm.common import staged

    counts = staged(awkward.sparkSession, hmm.word_counts(awkward), "t")
    voc = hmm.Vocabulary(counts, hot=10)
    rows = counts.toPandas()
    cls, *_ = voc.encode(rows.h.to_numpy().view(np.uint64), rows.suffix.to_numpy())
    per = np.bincount(cls, rows.c + 1, minlength=hmm.CLASSES)
    assert np.allclose(per + 1, voc.class_total)  # the 1 is left to unknown words


def test_model_beats_unigrams_on_held_out_text(spark, sf_dir):
    rows = hmm.score_report(spark.read.parquet(f"{sf_dir}/documents.parquet")).filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_joined_words_score_like_hot_ones(spark, sf_dir, monkeypatch):
    """Few or all words in the table that goes to the tasks: the model is the same."""
    monkeypatch.setattr(hmm, "BATCH_BYTES", 1 << 14)  # several blocks a task
    found = []
    for hot in (hmm.SINGLES, hmm.HOT):
        monkeypatch.setattr(hmm.Vocabulary.__init__, "__defaults__", (hot,))
        rows = hmm.score_report(spark.read.parquet(f"{sf_dir}/documents.parquet")).orderBy("doc_id").collect()
        found.append(np.array([[r.n_known, r.base_score, r.score] for r in rows]))
    assert np.allclose(found[0][:, :2], found[1][:, :2])
    assert np.allclose(found[0][:, 2], found[1][:, 2], rtol=1e-4)


def test_words_of_a_piece_are_hashed_once(monkeypatch):
    hashed = []
    monkeypatch.setattr(hmm, "word_hashes", lambda norm, whole=hmm.word_hashes: hashed.append(len(norm.split())) or whole(norm))
    batch = pa.RecordBatch.from_pydict({"text": ["the cat and the dog " * 500, None, "The end"]})
    (rows,) = hmm._count(iter([batch]))
    assert sum(hashed) == 5 and sum(rows["n"].to_pylist()) == 2502 + 3


@pytest.mark.parametrize("given", [[d[1] for d in DOCS], [None, "", " \t\n\x0b\x0c\r "], ["a\x1cb\x85c\u00a0d\x00 e", "\x0b É \x0cÉ  A"]])
def test_tokens_of_texts_are_those_of_each(given):
    h, suffix, which, sizes = hmm.tokens(pa.array(given, pa.string()))
    words = [(t or "").encode().lower().split() for t in given]
    assert sizes.tolist() == [len(w) + 1 for w in words]
    want = [x for w in words for x in [*(int(wordhash.word_hashes(x)[0]) for x in w), int(hmm.END)]]
    assert h[which].tolist() == want and len(set(h.tolist())) == len(h) == len(set(want))

    def of(word):
        n = 0
        for back in (1, 2, 3):
            n = (n * 131 + (word[-back] if back <= len(word) else 0)) % 1_000_003
        return n % hmm.SUFFIXES
    kinds = {x: of(x) for w in words for x in w}
    assert suffix[which].tolist() == [n for w in words for n in [*(kinds[x] for x in w), 0]]


def test_low_keys(spark):
    df = spark.range(5000).select(F.xxhash64("id").alias("k"), "id")
    assert [r.k for r in low_keys(df, "k", 30).collect()] == sorted(r.k for r in df.collect())[:30]
    assert low_keys(df.limit(0), "k", 3).count() == 0 and low_keys(df.limit(2), "k", 9).count() == 2


@pytest.mark.parametrize("hot", [20, hmm.HOT])  # the rare words take the join, or the table of hot words
def test_words_of_one_class_are_told_apart_by_state(spark, monkeypatch, hot):
    monkeypatch.setattr(hmm.Vocabulary.__init__, "__defaults__", (hot,))
    rng, given = random.Random(0), []
    held, trained = ([i for i in range(2000) if (zlib.crc32(str(i).encode()) % 7 == 2) == h] for h in (True, False))
    for n, i in enumerate(trained[:400]):
        topic = "ab"[n % 2]
        common = [f"{(n // 2 * 40 + j) % 1600}{topic * 2}" for j in range(40)]  # 3,200 words, 5 times each
        common += [f"mark{topic}{j % 5}" for j in range(60)]
        given.append((i, " ".join([*common, *(f"{topic}{(n // 2 + j) % 100}zzz" for j in range(2))])))  # 4 times each
    for n, (at, rare) in enumerate(["aa", "ab", "bb", "ba"]):
        given.append((held[n], " ".join([*(f"mark{at}{j % 5}" for j in range(60)), f"{rare}7zzz", f"{rare}8zzz"])))
    rng.shuffle(given)
    rows = {r.doc_id: r for r in hmm.score_report(spark.createDataFrame(given, "doc_id long, text string")).collect()}
    aa, ab, bb, ba = (rows[held[n]] for n in range(4))
    assert aa.base_score == pytest.approx(ab.base_score) and aa.n_known == ab.n_known == 63
    assert aa.score > ab.score + 0.5 and bb.score > ba.score + 0.5


def test_lowest(spark):
    df = spark.range(5000).withColumn("text", F.lit("row")).repartition(7)
    key = F.xxhash64("id")
    want = {r.id for r in df.orderBy(key).limit(30).collect()}
    assert {r.id for r in lowest(df, key, 30).collect()} == want
    assert lowest(df.limit(0), key, 3).count() == 0 and lowest(df.limit(2), key, 9).count() == 2
