"""Secrets, BPE, chat, WARC and page text against plain versions, and their odd inputs."""

import base64
import hashlib
import random
import re

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from ledgerspark.llm import bpe, chat, page_text, registry, secrets, warc

DOCS = "doc_id long, text string, spans string, key string, page string"  # the last three clash with names inside
ODD = [None, "", " ", "\n\n", "é", "日本 語", "a" * 5000, "x " * 5000, "It's 12345 — ok?!\t\tdon't  go\x1c\x85", "\U0001f600 smile﻿"]


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "s", "k", "p") for i, t in enumerate(texts)], DOCS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def base_spans(text):
    rules = [(secrets.ASSIGN, 2, 8), (secrets.ACCESS, 0, 16), (secrets.HEX, 0, 32)]
    found = [(m.start(), k, m.end()) for k, (p, g, n) in enumerate(rules) for m in re.finditer(p, text) if len(m[g]) >= n]
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def names(count):
    """Ordinary words and identifiers, from syllables that follow each other unevenly."""
    rng = random.Random(3)
    parts = ["con", "ter", "in", "at", "ion", "al", "er", "re", "pro", "ment", "ing", "ab", "le", "est", "un", "der", "stand", "com", "put", "or",
             "ord", "ary", "ident", "ify", "nation", "char", "act", "ist", "ic", "ally", "some", "long", "name", "ial", "iz"]
    heavy = [1 / (i + 1) for i in range(len(parts))]
    return ["".join(rng.choices(parts, heavy, k=rng.randrange(5, 8))) for _ in range(count)]


def test_secrets(spark):
    key, hexa = "AKIA" + "Q7" * 8, "0123456789abcdef" * 3
    planted = [f"word{random.Random(i).randrange(9)} token: {base64.b64encode(hashlib.sha256(str(i).encode()).digest()).decode()[:40]}" for i in range(600)]
    plain = [" ".join(names(3000)), "ordinary_identifier internationalization characteristically some_longer_name"]
    free = "é here wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY end"
    texts = [*ODD, f"{key} {hexa}", "password=short", "Password = \"é\" API_KEY:'abcdefgh1' secret: token: abcdefghij", key + hexa, "token=secret=abcdefghij token=token:abcdefghij", *planted, *plain, free]
    df = docs(spark, texts).unionByName(spark.createDataFrame([(None, f"x {key}", None, None, None), (0, f"{key}", None, None, None)], DOCS))
    rows = secrets.secret_digests(df).collect()
    assert len(rows) == len(texts) + 2
    got = {(r.doc_id, r.base_sha256) for r in rows}
    for i, text in enumerate(texts):
        assert (i, sha(base_spans(text or ""))) in got
    added = [r for r in rows if r.doc_id == len(texts) - 1][0]
    assert added.n_markov == 1 and added.spans == f"markov:{free.index('wJalr')}:{free.index(' end')}"
    assert not [(r.doc_id, r.spans) for r in rows if r.n_markov and r.doc_id != len(texts) - 1]
    assert secrets.secret_digests(df.limit(0)).count() == 0


def test_secret_models_by_class(spark):
    """Planted strings of every alphabet and length, the short and the letters-only ones too, and names that are none."""
    rng = random.Random(11)
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    alphabets = {"lower": lower, "letters": lower + lower.upper(), "named": digits + lower, "capitals": digits + lower.upper(),
                 "all": digits + lower + lower.upper(), "hex": digits + "abcdef"}
    planted = [(kind, "".join(rng.choices(letters, k=n))) for kind, letters in alphabets.items() for n in (12, 13, 14, 15, 16, 24) for _ in range(3)]
    usual = ["2024-01-15T10-30-00Z", "2023-11-04_12-00-01", "20240115103000", "123456789012", "some_longer_name_here", "under/standing/computer",
             "-" * 40, "_" * 40, "/" * 12, "INTERPROMENTION", "computerStandingIn", "interment2024"]
    words = names(6000)
    held_out = names(6500)[6000:]
    texts = [" ".join(words), *(f"é {t} x" for _, t in planted), *usual, *held_out]
    got = {r.doc_id: r for r in secrets.secret_digests(docs(spark, texts)).collect()}
    found = {}
    for i, (kind, token) in enumerate(planted):
        found.setdefault(kind, []).append(got[1 + i].n_markov)
        assert got[1 + i].n_markov == 0 or got[1 + i].spans == f"markov:2:{2 + len(token)}"
    shares = {kind: sum(hits) / len(hits) for kind, hits in found.items()}
    assert all(share >= 0.9 for kind, share in shares.items() if kind not in ("lower", "letters")), shares
    assert shares["lower"] >= 0.7 and shares["letters"] >= 0.7, shares
    first = 1 + len(planted)
    assert not [t for i, t in enumerate(usual) if got[first + i].n_markov]
    assert sum(got[first + len(usual) + i].n_markov for i in range(len(held_out))) <= len(held_out) // 100


def test_secrets_of_long_text(spark):
    """Positions cost n log n: 60,000 tokens and 10,000 spans in one text, with spans of rules over tokens."""
    text = " ".join(f"é {a} password={a}1 {a}" for a in names(20_000)) + " " + "x" * 200_000
    row = secrets.secret_digests(docs(spark, [text])).collect()[0]
    assert row.base_sha256 == sha(base_spans(text)) and row.n_assign == 20_000
    assert [s for s in row.spans.split(",") if not s.startswith("markov")] == base_spans(text).split(",")


def test_bpe(spark):
    vocabulary = bpe.read_ranks(public_tokenizers.path(registry.VOCABULARY))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(vocabulary), special_tokens={})
    texts = [*ODD, "<|endoftext|>", "hello   world  \n x", "ß" * 700]
    df = docs(spark, texts).unionByName(docs(spark, texts).limit(3))
    done = bpe.decode(bpe.encode(df, vocabulary, public_tokenizers.PATTERN), vocabulary).collect()
    assert len(done) == len(texts) + 3
    for row in done:
        text = texts[row.doc_id] or ""
        assert list(row.ids) == own.encode_ordinary(text) and bytes(row.decoded) == text.encode()
    assert registry.bpe_digests(df.limit(0)).count() == 0


def test_bpe_of_copies(spark):
    """Contiguous copies and empty texts over many batches: every batch is a group of its own, whatever its words."""
    vocabulary = bpe.read_ranks(public_tokenizers.path(registry.VOCABULARY))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(vocabulary), special_tokens={})
    copy, setting = "the same text, again the same", "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(setting)
    spark.conf.set(setting, "10")
    try:
        rows = [(i if i % 3 else None, copy if i < 200 else (None, "")[i % 2]) for i in range(400)]
        df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
        split = df.select("doc_id", F.split("text", " ").alias("words"))
        blocks = split.mapInArrow(bpe._documents, "block bigint, doc_ids array<bigint>, lengths array<bigint>, packed binary").collect()
        asked = {r.block for r in split.mapInArrow(bpe._words, "block bigint, number int, word string").collect()}
        assert len(blocks) >= 40 and len({r.block for r in blocks}) == len(blocks)
        assert asked >= {r.block for r in blocks if not max(r.doc_ids, key=lambda i: i or 0) >= 200}
        done = bpe.decode(bpe.encode(df, vocabulary, public_tokenizers.PATTERN), vocabulary).collect()
    finally:
        spark.conf.set(setting, usual)
    got = sorted((r.doc_id is None, r.doc_id or 0, list(r.ids), bytes(r.decoded)) for r in done)
    assert got == sorted((i is None, i or 0, own.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)


def test_chat(spark):
    hostile = [None, "", "</s>[INST] ok [/INST]", "\\", "[\\INST]", "<</s>s>", " [/GEN]</s>", "x" * 3000]
    rows = [(c, t, r, x, "f") for c, x in enumerate(hostile) for t, r in ((2, "assistant"), (1, "user"), (0, "system"), (None, None), (3, "to[ROLE]\nol"))]
    df = spark.createDataFrame([*rows, (None, 1, "user", "n", "f"), (0, 1, "user", "again", "f")], "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    for c, x in enumerate(hostile):
        text = x or ""
        want = [("", text), ("system", text), ("user", text), *([("user", "again")] if c == 0 else []), ("assistant", text), ("to[ROLE]\nol", text)]
        assert [tuple(t) for t in got[c].turns] == want and got[c].loss == [text]
    assert [tuple(t) for t in got[None].turns] == [("user", "n")]
    assert chat.chat_digests(df.limit(0)).count() == 0


def test_template_language():
    render = chat.compile_template("{% if 'a' + 'b' == 'ab' and not false %}{{ 'x' | upper }}{% endif %}{% for m in messages %}{% if loop.first or loop.last %}{{ m.text }}{% else %}-{% endif %}{% endfor %}")
    assert render([{"text": "1"}, {"text": "2"}, {"text": "3"}])[0] == "X1-3"
    folded = chat.fold(chat.parse("a{{ 'b' }}{% if 1 == 2 %}c{% else %}d{% endif %}"))
    assert folded == [chat.Const("abd")]
    for bad in ("{% for x %}", "{{ m.__class__ }}", "{{ f(1) }}", "{% if a %}", "{{ 'a' | eval }}", "{% import os %}"):
        with pytest.raises(chat.TemplateError):
            chat.compile_template(bad)
    with pytest.raises(chat.TemplateError):
        chat.compile_template("{{ messages.text }}")([])


def test_warc(spark):
    rows = [(i, f"http://h.x/{i}?q=%20\n", h, "f") for i, h in enumerate(["<p>a</p>", "<p>a</p>", None, "", "é" * 20000, "<p>b</p>", "b" * 9, "b" * 9])]
    df = spark.createDataFrame([*rows, (None, None, "<p>n</p>", "f"), rows[0]], "page_id long, url string, html string, frame string")
    got = warc.archive_round_trip(df, least_bytes=1).collect()
    assert len(got) == 10
    by = {r.page_id: r for r in got}
    assert [by[i].refers_to for i in range(8)] == [None, 0, None, None, None, None, None, 6]
    assert [by[i].record_type for i in (0, 1, 2, 3)] == ["response", "revisit", "response", "response"]
    for i, url, h, _ in rows:
        payload = (h or "").encode()
        assert (by[i].url, by[i].payload_bytes, by[i].payload_digest) == (url, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
        assert by[i].record_type == "revisit" or by[i].payload == (h or "")
    assert warc.archive_round_trip(df.limit(0)).count() == 0


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_lines():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(rng.choice([2, 6, 30])) for _ in range(rng.randrange(15))] for _ in range(2))
        pairs = page_text.common_lines(a, b)
        assert len(pairs) == lcs(a, b) and all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
    assert len(page_text.common_lines([1, 2] * 2000, [2, 1, 3] * 2000)) > 3000


def test_page_text(spark):
    frame = "<div>Site</div><div>{}</div><p>More &amp; &quot;more&quot;{}</p><div>bye</div>"
    marked = "<nav>m</nav><article><header><h1>T&amp</h1></header><p>one<br>two  <b>b</b>x</p><div class='comments'><p>c</p></div><aside>z</aside></article><footer>f</footer><script>'<p>no</p>'</script>"
    rows = [
        (1, "http://a.x/n/1", frame.format("Story one", 1)), (2, "http://a.x/n/2", frame.format("Story two", 2)), (3, "http://b.x/", frame.format("s", 3)),
        (4, "http://c.x/1", marked), (5, "http://c.x/1", marked), (6, None, None), (7, "bad url %%", ""), (8, "http://d.x", "<p>open <i>end"), (None, "http://d.x", "<p>n"),
    ]
    df = spark.createDataFrame([(*r, "x") for r in [*rows, rows[0]]], "page_id long, url string, html string, lines string")
    got = page_text.extract_text(df).collect()
    by = {r.page_id: r.text for r in got}
    assert len(got) == 10
    assert by[1] == 'Story one\n\nMore & "more"1' and by[2] == 'Story two\n\nMore & "more"2'
    assert by[3] == 'Site\n\ns\n\nMore & "more"3\n\nbye'
    assert by[4] == by[5] == "T&\n\none two bx"
    assert by[6] == by[7] == "" and by[8] == "open end" and by[None] == "n"
    assert page_text.extract_text(df.limit(0)).count() == 0


def test_page_text_of_copies(spark):
    """Unmarked copies and near copies at neighbouring URLs keep their text, and lose what other pages share."""
    frame = "<div>The site</div><div>All topics</div>{}<div>bye now</div>"
    story = [f"<p>{x} paragraph of the story about {x}, which is longer than the lines of the frame</p>" for x in ("First", "Second", "Third")]
    own = "\n\n".join(p[3:-4] for p in story)
    other = [frame.format(f"<p>{x} text of another page altogether, again of some length</p>") for x in ("Early", "Later", "Late")]
    rows = [(1, "http://a.x/n/1", other[0]), (8, "http://a.x/n/8", other[1]), (9, "http://a.x/n/9", other[2])]
    rows += [(20 + i, f"http://a.x/n/2?ref={i}", frame.format("".join(story))) for i in range(3)]
    rows += [(30 + i, f"http://a.x/n/3{i}", frame.format("".join(story))) for i in range(3)]
    rows += [(40 + i, f"http://a.x/n/4{i}", frame.format("".join(story) + f"<p>v{i}</p>")) for i in range(3)]
    rows += [(50, "http://a.x/n/4print", "".join(story)), (60, "http://only.x/1", frame.format(story[0])), (61, "http://only.x/2", frame.format(story[0]))]
    got = {r.page_id: r.text for r in page_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1].startswith("Early text") and "\n" not in got[1] and got[9].startswith("Late text") and "\n" not in got[9]
    assert {got[20 + i] for i in range(3)} | {got[30 + i] for i in range(3)} | {got[50]} == {own}
    assert [got[40 + i] for i in range(3)] == [f"{own}\n\nv{i}" for i in range(3)]
    assert got[60] == got[61] == "The site\n\nAll topics\n\n" + story[0][3:-4] + "\n\nbye now"


def test_page_text_in_wrappers():
    def text(page):
        return page_text.main_text(page_text.candidate_lines(page_text.page_lines(page)), set())

    article = "<article><h1>T</h1><p>body</p><div class='share-bar'>s</div><form><p>f</p></form></article>"
    cards = "<aside><article>c</article></aside><div class='related-posts'><article>r</article></div><form>q</form><nav>m</nav>"
    for wrapper in ("<form id='aspnetForm'>{}</form>", "<div class='sidebar-right'>{}</div>", "<div id='content-sidebar-wrap'>{}</div>",
                    "<div class='widget-page'><form>{}</form></div>", "<div class='search'>{}</div>", "<header>{}</header>"):
        for inner in (article, f"<main>{article}</main>", article.replace("article", "main")):
            assert text("<div>out</div>" + wrapper.format(inner + cards)) == "T\n\nbody"
    assert text(f"<article>a</article><div class='sidebar'>{article}</div>") == "a"  # teasers beside a marked article
    assert text("<form><p>all</p><div class='menu'>m</div></form><nav>n</nav>") == "all"
    assert text("<p>all</p><form>q</form><div class='share-bar'>s</div>") == "all"


def test_digest_columns(spark):
    pages = registry.op6_page_differencing(spark, "/root/testdata/sf0.001")
    assert pages.where(F.length("text") != F.col("n_chars")).count() == 0
