"""Tokens, packing, languages, pages: against the library, brute force and exact round trips."""

import hashlib
import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewell.llm import bpe, html_text, language, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
CODEC = bpe.BytePairCodec(open(PATH, encoding="utf-8").read())
TOKENS = packing.Tokens(open(PATH, encoding="utf-8").read())


def ids(text):
    return np.array(LIBRARY.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t ab'stTé日\x1c　.,!1"), st.characters(codec="utf-8")), max_size=40))
def test_codec_is_the_library(text):
    assert CODEC.encode(text) == ids(text) == TOKENS([text])[0]
    assert CODEC.decode(CODEC.encode(text)) == text


def test_codec_special_and_long():
    for text in ("a<|endoftext|>b", "<|endoftext|>" * 2, "ab" * 5000, " x" * 3000, "z" * 4097):
        assert CODEC.encode(text) == ids(text) == TOKENS([text])[0]
        assert CODEC.decode(ids(text)) == LIBRARY.decode(np.frombuffer(ids(text), "<u4").tolist(), skip_special_tokens=False)


def test_merge_by_hand():
    """Leftmost lowest rank first, by repeated scans."""
    for word in ("hello", "aaaaaaa", "mississippi", "é", "abcabcabc"):
        symbols = [CODEC.of_byte[b] for b in word.encode()]
        slow = symbols[:]
        while True:
            ranked = [(CODEC.pairs[k][0], i) for i in range(len(slow) - 1) if (k := slow[i] << 32 | slow[i + 1]) in CODEC.pairs]
            if not ranked:
                break
            _, i = min(ranked)
            slow[i : i + 2] = [CODEC.pairs[slow[i] << 32 | slow[i + 1]][1]]
        assert CODEC.merge(symbols) == slow


def test_op10(spark, odd, empty):
    got = {r["doc_id"]: r for r in bpe.encode(odd, PATH).collect()}
    assert len(got) == 8 and got[7]["ids"] == ids("  é 日本 \u0000 <|endoftext|>\n\n tab\t") and got[1]["ids"] == b""
    assert bpe.encode(empty, PATH).count() == 0
    row = bpe.query(spark, "/root/testdata/sf0.001").where("doc_id = 0").collect()[0]
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id = 0").collect()[0]["text"]
    assert (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) == (len(ids(text)) // 4, hashlib.sha256(ids(text)).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def check_packing(rows, texts):
    whole = {i: [np.frombuffer(ids(t or "") + b"\1\0\0\0", "<u4") for t in ts] for i, ts in texts.items()}
    for i, pieces in rows.items():
        assert sum(p["length"] for p in pieces) == sum(map(len, whole[i]))
        for p in pieces:
            cut = [w[p["start"] : p["start"] + p["length"]] for w in whole[i] if len(w) == p["doc_tokens"]]
            assert p["ids_crc32"] in {zlib.crc32(c.tobytes()) for c in cut} and p["length"] > 0
    used = {}
    for pieces in rows.values():
        for p in pieces:
            used.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    full = 0
    for spans in used.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 2048
        full += at == 2048
    assert full >= len(used) - 1


def by_id(rows, key="doc_id"):
    out = {}
    for r in rows:
        out.setdefault(r[key], []).append(r)
    return out


def test_op2(spark, docs, odd, empty):
    check_packing(by_id(packing.query(spark, "/root/testdata/sf0.001").collect()), by_texts(docs))
    check_packing(by_id(packing.digest(packing.pack(odd, PATH)).collect()), by_texts(odd))
    check_packing(by_id(packing.digest(packing.pack(odd.repartition(3), PATH)).collect()), by_texts(odd))
    assert packing.pack(empty, PATH).count() == 0


def test_distinct_stretches_are_asked_for_together(monkeypatch):
    """Of a batch each distinct stretch reaches the library once, and many of them in one text."""
    tokens = packing.Tokens(open(PATH, encoding="utf-8").read())
    asked, ask = [], tokens._ask
    monkeypatch.setattr(tokens, "_ask", lambda texts, *a, **b: asked.extend(texts) or ask(texts, *a, **b))
    words = [f"w{k}é,\n{k}'s" for k in range(3000)]
    letters = "aeiouéèçßñÅÿ"
    plain = [a + b + c + end for a in letters for b in letters for c in letters for end in ("", ".", ",", "ª", "×", "..", ",a")]
    texts = [" ".join(words), " ".join(plain), " ".join(["head", *words[::-1]]), "", "one", "x " + words[0], "two  spaces", "a<|endoftext|> b"]
    assert tokens(texts) == [ids(t) for t in texts]
    assert len(asked) <= 20 and sum(t.count(words[5]) for t in asked) == 1
    tokens.opens[:] = False  # tokens that don't keep to the stretches
    tokens.held = tuple(x[:0] for x in tokens.held)
    assert tokens(texts) == [ids(t) for t in texts]
    assert packing.Tokens(open(PATH, encoding="utf-8").read()).column(pa.array([], pa.string())).to_pylist() == []


def test_stretches_share_their_pieces(monkeypatch):
    """A plain piece is asked for once, whatever it stands with, and the ids are the library's for every kind of character."""
    tokens = packing.Tokens(open(PATH, encoding="utf-8").read())
    asked, ask = [], tokens._ask
    monkeypatch.setattr(tokens, "_ask", lambda texts, *a, **b: asked.extend(texts) or ask(texts, *a, **b))
    texts = ["Of blarquzé", "a blarquzé. blarquzé, blarquzé$$$ blarquzé.\nBlarquzé x.\nblarquzé", "blarquzé 12blarquzé.36@mail"]
    assert tokens(texts) == [ids(t) for t in texts]
    assert sum(t.encode().count("\u0120blarquz".encode()) for t in asked) == 1
    odd = [f"ab{chr(c)}cd é{chr(c)} {chr(c)}x 1{chr(c)} {chr(c)}'s" for c in (*range(0x250), *range(0x2000, 0x2070), 0x1680, 0x3000, 0xFEFF, 0x1F600)]
    texts = ["", *odd, *texts, "", " ", "\n", "×", "÷a b", "'s 'll x's", "z" * 300 + "\n" + "z" * 300, ""]
    assert tokens(texts) == [ids(t) for t in texts] and tokens(texts[3:9]) == [ids(t) for t in texts[3:9]]
    monkeypatch.setattr(packing, "MEMORY", 8)  # what is remembered is let go
    assert tokens(texts) == tokens(texts[::-1])[::-1] == [ids(t) for t in texts]
    assert tokens.column(pa.array(["x", *texts]).slice(2), b"end").to_pylist() == [ids(t) + b"end" for t in texts[1:]]
    tokens.size[:] = 0  # tokens that don't spell the bytes
    tokens.pieces, tokens.old_pieces = {}, {}
    assert tokens(texts) == [ids(t) for t in texts]


def test_other_normalizers_go_to_the_library():
    held = json.loads(open(PATH, encoding="utf-8").read()) | {"normalizer": {"type": "Lowercase"}}
    library = Tokenizer.from_str(json.dumps(held))
    texts = ["The CAT. sat", "ÀB cD,\nEf", ""]
    assert packing.Tokens(json.dumps(held))(texts) == [np.array(library.encode(t).ids, "<u4").tobytes() for t in texts]


def by_texts(df):
    out = {}
    for r in df.select("doc_id", "text").collect():
        out.setdefault(r["doc_id"], []).append(r["text"])
    return out


def test_automaton_parses_greedily():
    samples = {"a": "abracadabra", "b": "hocus pocus"}
    parser = language.CrossParser(samples)

    def slow(text, sample):
        """A phrase ends where it can't be followed further; the next starts with the letter that broke it."""
        count, at = 0, ""
        for c in text:
            if at + c in sample and at + c:
                at += c
            else:
                count += 1
                at = c if c in sample else ""
        return count + 1

    for text in ("abra", "cadab hocus", "zzz", "pocus abracadabra xyz ab"):
        cost, sizes = parser.costs([text])
        for k, s in enumerate(samples.values()):
            assert round(cost[0, k] * sizes[0] / parser.bits[k]) == slow(text, s), (text, s)


def test_every_learned_character_counts():
    """Two languages of one frequent alphabet and many rare letters each: the rare ones tell them apart."""
    common = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿāăąćĉċč" * 40
    one, two = (" ".join(chr(start + k) + chr(start + (7 * k + 1) % 400) for k in range(400)) for start in (0x4E00, 0x6000))
    high = "".join(map(chr, range(0x20000, 0x20080)))
    parser = language.CrossParser({"one": common + one, "two": common + two, "xhigh": high})
    assert len(set(parser.symbols.of.values())) == parser.symbols.size - 1 > 800
    assert parser.predict([one[300:600], two[300:600], high[20:60]])[0] == ["one", "two", "xhigh"]
    got, numbers = language.letters("a " + one[:9] + high[:3]), parser.symbols.numbers("a " + one[:9] + high[:3])
    assert list(numbers) == [parser.symbols.of[c] for c in got] and min(numbers) > 0
    for text in (one[:50] + "!" + two[:50], "abc" + high[5:9] + "zzz \u3042"):
        costs, sizes = parser.costs([text])
        for k, sample in enumerate([common + one, common + two, high]):
            count, at = 0, ""
            for c in language.letters(text):
                if at + c in sample:
                    at += c
                else:
                    count, at = count + 1, c if c in sample else ""
            assert round(costs[0, k] * sizes[0] / parser.bits[k]) == count + 1


def test_letters_as_numbers():
    parser = language.CrossParser({"x": "abc def é"})
    for text in ("a b", "  a,, b!! ", "", "!!", "é", "x", "ab ", " ab", "\U0001d400 a", "a1b"):
        got = [] if not text else list(parser.symbols.numbers(text))
        assert got == [parser.symbols.of.get(c, 0) for c in language.letters(text)]


def test_op4(spark, odd, empty):
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = [r for r in language.query(spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]] for r in rows) >= 0.97 * len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    got = by_id(language.identify(odd, {"en": "one two same text", "xx": "qqq"}).collect())
    assert got[1][0]["lang_pred"] == "und" and got[3][0]["lang_pred"] == "en" and len(got[6]) == 2
    assert {r["lang_pred"] for r in language.identify(odd, {}).collect()} == {"und"} and language.identify(empty, {"a": "b"}).count() == 0


def test_main_text():
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><header><a href='/'>Home</a></header><nav><ul><li><a>x</a></ul></nav><div class='cookie-notice'>We use cookies</div>"
        "<article><h1>Ti&amp;tle</h1><p>First  para\n of text<br>second<p>third <b>bold</b>ly<div class='ad'>Buy</div><form>in</form><script>if (a<b) '</p>'</script></article>"
        "<section id='comments'><p>reader says</p></section><aside>side</aside><footer>&copy; x</footer></body></html>"
    )
    assert html_text.main_text(page) == "Ti&tle\nFirst para of text\nsecond\nthird boldly"
    plain = "<div class='menu'><a>x</a></div><div><h2>Hi</h2><p>" + "word " * 40 + "</p><p>short</p></div><div class=comments><p>bad</p></div>"
    assert html_text.main_text(plain) == "Hi\n" + ("word " * 40).strip() + "\nshort"
    for page in (None, "", "<p>", "<!-- x", "<nav>a</nav>", "<script>x"):
        assert html_text.main_text(page) == ""
    assert html_text.main_text("a < b &lt; c") == "a < b < c"


def test_stretches():
    assert html_text.stretches([5, 0, 0, 0, 90, 3, 0, 70, 0, 0, 0, 4]) == [(2, 8)]
    assert html_text.stretches([5, 0, 0, 0, 0, 9]) == [(3, 6)] and html_text.stretches([]) == []


def test_short_paragraph_between_long_ones():
    """Unmarked pages keep a short stretch between two that surge, none before or after."""
    long, ad = "<p>" + "word " * 40 + "</p>", "<div class=ad>Buy</div>"
    text = ("word " * 40).strip()
    assert html_text.main_text(f"<p>before</p>{ad}{long}{ad}<p>Short but real.</p>{ad}{long}{ad}<p>after</p>") == f"{text}\nShort but real.\n{text}"


LONG = ("word " * 40).strip()
PARA = f"<p>{LONG}</p>"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f'<div class="layout has-sidebar"><h1>T</h1>{PARA}</div>', f"T\n{LONG}"),
        (f'<div class="content no-sidebar">{PARA}</div>', LONG),
        (f'<body><div id="page-with-comments"><h1>T</h1>{PARA}</div></body>', f"T\n{LONG}"),
        (f'<div class="entry-header"><h1>Head</h1></div>{PARA}', f"Head\n{LONG}"),
        (f'<article><div class="entry-header"><h1>Head</h1></div>{PARA}</article>', f"Head\n{LONG}"),
        (f'<div class="sidebar-page"><h1>T</h1>{PARA}</div>', f"T\n{LONG}"),
        (f'<div class="nav-x">{PARA}</div>', LONG),
        (f'<h1>T</h1>{PARA}<section id="comments"><article><p>{LONG * 9}</p></article></section>', f"T\n{LONG}"),
        (f"<article>Card one</article><div><h1>T</h1>{PARA * 9}</div>", "T" + f"\n{LONG}" * 9),
        (f"<ul><li><a>Home</a><li><a>About</a></ul><h1>T</h1>{PARA}<ul><li><a>One</a><li><a>Two</a><li><a>Three</a></ul>", f"T\n{LONG}"),
        (f"<div>Home</div><div>Shop</div><div>Blog</div><div>Us</div><h1>T</h1>{PARA}", f"T\n{LONG}"),
        (f"<div class=menu>a</div><h1>T</h1><p>By X</p><p>1 May</p><p>Rome</p>{PARA}", f"T\nBy X\n1 May\nRome\n{LONG}"),
        (f"<article>{PARA}<div class=ad>Buy<p>a<p>b<p>c<p>d</div><p>End.</p></article><p>beyond</p>", f"{LONG}\nEnd."),
        ("<article><p>One two <span class=ad>buy</span> three</p></article>", "One two three"),
        (f"{PARA}<p hidden>x</p><a class=nav>Next</a><p>t</p>", f"{LONG}\nt"),
        ("<p>Hi there</p>", "Hi there"),
        ("<ul><li><a>One</a><li><a>Two</a></ul>", "One\nTwo"),
    ],
)
def test_layouts(page, want):
    assert html_text.main_text(page) == want


def test_distribution_finds_unmarked_articles(spark):
    """Without article, nav, footer and class, surge and dive alone give the same text; without them every line would stay."""
    import re

    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        bare = re.sub(r'<(/?)(?:article|nav|footer)>', r"<\1div>", r["html"]).replace(' class="ad"', "")
        want, got = html_text.main_text(r["html"]).split("\n"), html_text.main_text(bare).split("\n")
        lines = [x.text for x in html_text.lines_of(bare)[0] if x.text]
        # A footer without marks touches the article and may stay.
        assert got[: len(want)] == want and len(got) <= len(want) + 1 < len(lines)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="<>/ab pdivtrl='\"&;!-", max_size=80))
def test_pages_never_fail(text):
    html_text.main_text(text)


def test_op8(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    import html
    import re

    for r in html_text.query(spark, "/root/testdata/sf0.001").collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)
        if inner:
            parts = [" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?p>|<br>|</?h1>", inner[1])]
            assert r["text"] == "\n".join(filter(None, parts)) and r["n_chars"] == len(r["text"])
    odd = spark.createDataFrame([(1, "u", None, "t"), (1, "u", "", "t")], "page_id long, url string, html string, text string")
    assert [r["text"] for r in html_text.extract(odd).collect()] == ["", ""]
