"""Cleaners, segmenters and scores against short restatements, with the quirks spelled out."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from turnloom.functions import markup, prompts, script, similarity
from turnloom.functions import text as T
from turnloom.operators import extract, jsonwalk, quality, segment


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v")).alias("x")).first().x


def many(spark, values, fn):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", fn(F.col("v")).alias("x"))
    return [r.x for r in sorted(df.collect())]


def turns(spark, text, cut, **kw):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return [(r.role, r.text) for r in sorted(cut(df, ["doc_id"], **kw).collect(), key=lambda r: r.turn)]


def random_texts(seed, alphabet, n=200, longest=400):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(longest))) for _ in range(n)]


def test_latin_runs_like_a_loop(spark):
    """Runs of few letters hold each other, also once letters between have gone."""
    rng = random.Random(11)
    texts = ["".join(rng.choices("aabbcAB你é1", k=rng.randrange(0, 60))) for _ in range(400)] + ["ab" * 5000 + "你a你b", "", "你"]
    want = []
    for text in texts:
        rest = text
        for run in re.findall("[A-Za-z]+", text):
            rest = rest.replace(run, "")
        want.append((sorted(re.sub("[A-Za-z]", "", rest)), sorted(re.findall("[A-Za-z]", rest))))
    got = many(spark, texts, script.without_latin_runs)
    assert [(sorted(re.sub("[A-Za-z]", "", g)), sorted(re.findall("[A-Za-z]", g))) for g in got] == want


def test_strip_is_unicode_aware(spark):
    values = ["　 a b\x85\n", "\x1c x", "", " \t "]
    assert many(spark, values, T.strip) == [v.strip() for v in values]


def test_sentences_match_a_loop(spark):
    def loop(text):
        out, buffer = [], ""
        for ch in text:
            buffer += ch
            if ch in "。！？" or len(buffer) > 100:
                out.append(buffer)
                buffer = ""
        out = [s.strip() for s in [*out, buffer] if s.strip()]
        return "\n".join(s if s[-1] in "。！？" else s + "。" for s in out) or None

    texts = random_texts(3, "ab 你\n。！") + random_texts(4, "abcdefgh ij") + ["x" * 100 + "。", "x" * 101 + "。", "x" * 202, "", "。"]
    assert many(spark, texts, T.segment_sentences) == [loop(t) for t in texts]


def test_allowlist(spark):
    texts = random_texts(5, "aZ9 \n。，\"'“（）()-é你〃\t")
    ok = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 \n" + T.ALLOWED_PUNCTUATION)
    want = ["".join(c for c in t if c in ok or "一" <= c <= "鿿") for t in texts]
    assert many(spark, texts, lambda c: T.keep_allowed(c, script.HAN)) == want


def test_leading_chunk(spark):
    assert one(spark, "nav\nme@x.com\nhello 1,024 tokens", T.leading_chunk) == "hello "
    assert one(spark, "a@b.com\nx\n # T\nbody", T.leading_chunk) == "# T\nbody"
    assert one(spark, "plain\nedit\ntext", T.leading_chunk) == "plain\ntext"
    assert one(spark, "x\nlast@x.com", T.leading_chunk) is None
    assert one(spark, "y" * 20_000, T.leading_chunk) is None


def test_contaminated(spark):
    dirty = 'junk prompts/a],["the\nbody",null,[1]'
    assert one(spark, dirty, T.recover_contaminated) == "the\nbody"
    assert one(spark, "prompts/ alone", T.recover_contaminated) == "prompts/ alone"
    assert one(spark, 'x],["body",null,[', T.recover_contaminated) == 'x],["body",null,['
    assert one(spark, 'Jane],["body",null,[', lambda c: T.recover_contaminated(c, ("Jane",))) == "body"


def test_terms_and_truncation(spark):
    assert one(spark, "LoRA(low rank) GPU（卡) x()", T.format_terms) == "LoRA（low rank） GPU（卡） x()"
    assert one(spark, "abcd", lambda c: T.truncate(c, 3)) == "abc..."
    assert one(spark, "abc", lambda c: T.truncate(c, 3)) == "abc"
    assert one(spark, "abc", lambda c: T.clip(c, 3)) == "abc..."


def test_transcript(spark):
    text = "lost\nUser: hi\n  more \n\nAI:\nSystem: s\nassistant: not a marker\nModel:"
    assert turns(spark, text, segment.segment_transcript) == [
        ("user", "hi\n  more \n"),
        ("assistant", ""),
        ("system", "s\nassistant: not a marker"),
        ("assistant", ""),
    ]


def test_page_roles_quirks(spark):
    text = "x\nUsers like it\n\nAim high\nfoo\nYou:\nchatgpt\nAI: a"
    assert turns(spark, text, segment.segment_page_roles) == [
        ("user", "s like it"),
        ("assistant", "m high\nfoo"),
        ("user", ""),
        ("assistant", ""),
        ("assistant", "a"),
    ]
    assert turns(spark, text, segment.segment_page_roles, strict=True) == [("user", "chatgpt"), ("assistant", "a")]
    assert turns(spark, "User: a\nModel", segment.segment_page_roles) == [("user", "a")]


def test_ui_dump(spark):
    text = "skip\nUSER:   a\nb\nresponse:\nInput: c\noutput"
    assert turns(spark, text, segment.segment_ui_dump) == [("user", "a\nb"), ("assistant", ""), ("user", "c\noutput")]


def test_headings_quirks(spark):
    text = "top\r\nUser\nq\n\n**Model**\na\nUser\nModel\nb\n model \nc"
    expected = [("user", "top"), ("user", "q"), ("assistant", "a"), ("user", "Model\nb")]
    assert turns(spark, text, segment.segment_headings) == [*expected, ("assistant", "c")]
    assert turns(spark, text, segment.segment_headings, legacy=True) == [*expected, ("user", "c")]


@pytest.mark.parametrize("kind", ["transcript", "dump", "headings", "export"])
def test_round_trip(spark, data, kind):
    """Conversations written in a format and read back give the same turns."""
    from pyspark.sql import Window

    src = spark.read.parquet(f"{data}/conversations.parquet").filter("role <> 'system'")
    src = src.withColumn("turn", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1)
    names = {"transcript": ("User: ", "AI: "), "dump": ("Input: ", "Output: "), "headings": ("User\n", "Model\n")}
    user, bot = names.get(kind, ("", ""))
    if kind == "export":
        quoted = F.regexp_extract(F.to_json(F.array("text")), r"(?s)\A\[(.*)\]\z", 1)
        label = F.when(F.col("role") == "user", "user").otherwise("model")
        piece = F.concat(F.lit("["), quoted, F.lit("," + "null," * 7 + '"'), label, F.lit('"]'))
    else:
        piece = F.concat(F.when(F.col("role") == "user", user).otherwise(bot), F.col("text"))
    whole = src.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", piece.alias("p")))).alias("ps"))
    whole = whole.select("conv_id", F.array_join(F.transform("ps", lambda p: p["p"]), "\n").alias("text"))
    cut = {
        "transcript": segment.segment_transcript,
        "dump": segment.segment_ui_dump,
        "headings": segment.segment_headings,
        "export": lambda df, keys: extract.extract_export_array(df, keys, "text"),
    }[kind]
    read = sorted((r.conv_id, r.turn, r.role, r.text) for r in cut(whole, ["conv_id"]).collect())
    assert read == sorted((r.conv_id, r.turn, r.role, r.text) for r in src.collect())


def test_export_keeps_invalid_bodies_raw(spark):
    tail = ",null,null,null,null,null,null,null,"
    raw = (
        '[["prompts/x",null,[["first \\"q\\""' + tail + '"user"],["caf\\u00e9\\n\\u4f60"' + tail + '"model"],["a\nb\\n"'
        + tail + '"user"],["  Expand to view model thoughts "' + tail + '"model"],["café\\n你"' + tail + '"user"]]'
    )
    df = spark.createDataFrame([(1, raw)], "doc_id long, raw string")
    made = [(r.role, r.text) for r in sorted(extract.extract_export_array(df, ["doc_id"]).collect(), key=lambda r: r.turn)]
    assert made == [("user", 'prompts/x",null,[["first \\"q\\"'), ("assistant", "café\n你"), ("user", "a\nb\\n")]


def lcs_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


def test_scores(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abc你😀 ") for _ in range(rng.randrange(0, 90)))
    pairs = [(i, word(), word()) for i in range(120)] + [(900, "same", "same"), (901, "", "x"), (902, "x" * 200, "x" * 70)]
    df = spark.createDataFrame(pairs, "i int, a string, b string")
    a, b = F.col("a"), F.col("b")
    scored = df.withColumn("m", similarity.char_match(a, b)).withColumn("l", similarity.lcs_length(a, b))
    scored = scored.withColumn("loss", similarity.text_loss(a, b, F.col("m"), F.col("l")))
    for r in scored.collect():
        matched, common = sum(x == y for x, y in zip(r.a, r.b)), lcs_table(r.a, r.b)
        assert (r.m, r.l) == (matched, common)
        if not r.a:
            assert r.loss == 1.0
            continue
        longest, gap = max(len(r.a), len(r.b)), abs(len(r.a) - len(r.b))
        want = 1 - (0.4 * matched + 0.4 * common - 0.2 * gap) / longest
        assert r.loss == pytest.approx(min(max(want, 0.0), 1.0))
        if r.i == 900:
            assert r.loss == pytest.approx(0.2)


def test_verdicts(spark):
    good = "你好世界今天天气很好。" * 2
    assert many(spark, ["hello", "你好。", "你好" * 20, good], script.verdict) == ["script", "short", "sentences", "ok"]
    assert one(spark, "[INST]" + good + "\nenglish", lambda c: script.verdict_reply(c, F.lit("ok"))) == good


def test_gates(spark):
    assert many(spark, ["", "!!", "你好 ab", "你 abc"], script.passes_gate) == [False, True, True, False]
    assert many(spark, ["", "(abc)", "你好é", "éé你"], script.is_mostly_script) == [True, True, True, False]
    # the run "a" takes its letter out of "cat" too, which leaves two Latin letters for two Han ones
    assert many(spark, ["a你cat好", "ab你aabb你ab1"], script.is_mostly_script) == [False, True]
    assert many(spark, ["a你cat好"], lambda c: script.is_mostly_script(c, legacy=False)) == [True]


def test_best_of_n_matches_a_loop(spark):
    rng = random.Random(11)
    answers = [
        "你好世界今天天气很好呀。" * 4,
        "你好世界今天天气很好呀。abcdefgh abcdefg。" * 2,
        "你好世界今天天气很好呀一二三四五六七八九十一二三四五六七八九十",
        "hello",
        "你好。",
        "",
    ]
    rows = [(p, k, rng.choice(answers)) for p in range(150) for k in range(1, 4) if rng.random() < 0.9]
    cands = spark.createDataFrame(rows, "prompt_id long, attempt int, text string")
    measured = {(r.prompt_id, r.attempt): r for r in quality.score_candidates(cands).collect()}
    want = {}
    for p in range(151):
        best, chosen = 0.0, (None, quality.FALLBACK_ANSWER)
        for k in range(1, 4):
            r = measured.get((p, k))
            if r is None or r.score is None or r.score <= best:
                continue
            best, chosen = r.score, (k, r.answer)
            if r.share > 0.6 and r.sentences >= 2:
                break
        want[p] = chosen
    prompts_df = spark.range(151).withColumnRenamed("id", "prompt_id")
    made = {r.prompt_id: (r.attempt, r.answer) for r in quality.best_of_n(prompts_df, cands).collect()}
    assert made == want


def find_url(node):
    if isinstance(node, str):
        return node.strip() if node.strip().startswith(("http://", "https://")) else None
    if isinstance(node, dict):
        order = [node[k] for k in ("link", "url", "share_link", "source") if k in node] + list(node.values())
    else:
        order = node if isinstance(node, list) else []
    return next(filter(None, map(find_url, order)), None)


def find_talk(node):
    if isinstance(node, dict):
        for key in ("link", "conversations", "messages", "history", "chat"):
            if key in node:
                return node[key]
        below = node.values()
    elif isinstance(node, list):
        if node and (isinstance(node[0], str) or isinstance(node[0], dict) and {"role", "from"} & set(node[0])):
            return node
        below = node
    else:
        return None
    return next(filter(None, map(find_talk, below)), None)


def random_tree(rng, depth):
    if depth == 0 or rng.random() < 0.25:
        return rng.choice(["x", "", "[1]", "http://a.b/" + str(rng.randrange(99)), " https://c ", 1, 0, None, True, False, 2.5])
    if rng.random() < 0.5:
        return [random_tree(rng, depth - 1) for _ in range(rng.randrange(0, 4))]
    keys = rng.sample(["b", "a", "link", "url", "source", "messages", "chat", "role", "z"], rng.randrange(0, 4))
    return {k: random_tree(rng, depth - 1) for k in keys}


def test_json_search_matches_recursion(spark):
    rng = random.Random(21)
    trees = [random_tree(rng, 6) for _ in range(400)]
    texts = [json.dumps(t, ensure_ascii=False) for t in trees]
    assert many(spark, texts, jsonwalk.find_url) == [find_url(t) for t in trees]
    found = many(spark, texts, jsonwalk.find_conversation)
    for tree, hit in zip(trees, found):
        want = find_talk(tree)
        if not want:
            assert hit is None, (tree, hit)
        elif isinstance(want, str):
            assert (hit.kind, hit.raw) == ("STRING", want)
        else:
            assert json.loads(hit.raw) == want if hit.kind != "STRING" else False


def test_json_search_has_no_depth_limit(spark):
    deep = "[" * 60 + '{"chat":["a","b"]}' + "]" * 60
    assert one(spark, deep, jsonwalk.find_conversation).raw == '["a","b"]'
    assert one(spark, "not json", jsonwalk.find_conversation) is None


def test_only_whole_json_is_json(spark):
    good = ['{"a":1}', " [1, 2] ", "5", '"x"', "null", "true", '{"a":{"b":1,"b":2}}', '{"a":[{"b":1,"b":[2]}],"a":3}', "[]", "{}"]
    bad = ["5 apples", '"x" he said', "true story", "[1] see", '{"a":1} x', '{"a":1', '{"a":1,}', "1,2", "1] x", "1], [2", '1} x']
    bad += ['5,"w":6', "", "User: hi", "{'a':1}", '{"a":"x\ny"}', "[1,]", '{"a":1}{"b":2}', '1],"w":[2', "01"]
    for text in good:
        json.loads(text)
    for text in bad:
        with pytest.raises(ValueError):
            json.loads(text)
    kinds = many(spark, good + bad, jsonwalk.json_kind)
    assert [k is not None for k in kinds] == [True] * len(good) + [False] * len(bad)


def test_repeated_keys_do_not_hide_a_conversation(spark):
    doc = '{"z":{"k":1,"k":2},"y":[{"chat":["a","b"]}]}'
    assert one(spark, doc, jsonwalk.find_conversation).raw == '["a","b"]'


def test_children_are_typed_by_their_own_text(spark):
    """A repeated key somewhere in a container changes no type beside it."""
    doc = '{"a":[1,2,{"k":1,"k":2}],"b":{"chat":["hi","there"]}}'
    assert one(spark, doc, jsonwalk.find_conversation).raw == '["hi","there"]'
    doc = '[ -1, 2.5, true, null, "s,]", "{\\"", [ {"k":1,"k":[2]} ], {"k":"v","k":"w"}, {} ]'
    kids = one(spark, doc, lambda c: jsonwalk.children(F.lit("ARRAY"), c))
    kinds = ["BIGINT", "DOUBLE", "BOOLEAN", "VOID", "STRING", "STRING", "ARRAY", "OBJECT", "OBJECT"]
    assert [k.kind for k in kids] == kinds
    doc = '{"p":"[1]","q" : 7, "r":{"k":1,"k":2},"s":"x"}'
    kids = one(spark, doc, lambda c: jsonwalk.children(F.lit("OBJECT"), c))
    assert [(k.key, k.kind) for k in kids] == [("p", "STRING"), ("q", "BIGINT"), ("r", "OBJECT"), ("s", "STRING")]


def test_refused_documents_are_reported(spark):
    docs = ["[" * 1200 + "]" * 1200, '{"a":', '{"a":1}', "plain", None, "[1] x"]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, json string")
    made = sorted(tuple(r) for r in jsonwalk.refused(df, ["doc_id"]).collect())
    assert made == [(0, 2400, "depth"), (1, 5, "syntax"), (5, 5, "syntax")]


def test_text_that_starts_like_json_is_a_transcript(spark):
    df = spark.createDataFrame([(1, "5 notes\nUser: hi\nAI: yo"), (2, "[1]\nUser: a"), (3, "[1]")], "doc_id long, text string")
    made = sorted((r.doc_id, r.route, r.role, r.text) for r in extract.route_json_text(df, ["doc_id"]).collect())
    assert made == [(1, "text", "assistant", "yo"), (1, "text", "user", "hi"), (2, "text", "user", "a")]


def test_json_conversation_shapes(spark):
    docs = [
        '{"messages":[{"from":"human","value":"a"},{"role":"gpt","content":null},{"role":"x"}]}',
        '{"link":"http://x"}',
        '{"chat":"User: q\\nAI: r"}',
        "5",
    ]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, json string")
    made = sorted((r.doc_id, r.turn, r.role, r.text) for r in extract.json_find_conversation(df, ["doc_id"]).collect() if r.text is not None)
    assert made == [(0, 0, "human", "a"), (0, 2, "x", ""), (2, 0, "user", "q"), (2, 1, "assistant", "r")]


def test_json_nodes(spark):
    doc = '{"b":{"k":[{"x":1.5},2]},"a":[],"s":"[1]","n":null,"t":true}'
    made = {(n.path, n.type, n.length) for n in one(spark, doc, jsonwalk.json_nodes)}
    assert made == {
        ("$", "dict", None),
        ("$.b", "dict", None),
        ("$.b.k", "list", 2),
        ("$.b.k[0]", "dict", None),
        ("$.b.k[0].x", "float", None),
        ("$.a", "list", 0),
        ("$.s", "str", None),
        ("$.n", "NoneType", None),
        ("$.t", "bool", None),
    }


def test_an_export_without_messages_is_read_once(spark):
    import time

    df = spark.createDataFrame([('["a",1],' * 160_000,)], "raw string")
    started = time.time()
    assert df.select(F.size(extract.export_turns(F.col("raw")))).first()[0] == 0
    assert time.time() - started < 20
    tail = ",null" * 7 + ',"user"'
    blob = f'["x",1],["one ["two"{tail}, "no start"{tail}["three"{tail} ["rest"'
    assert [(t.role, t.text) for t in one(spark, blob, extract.export_turns)] == [("user", 'x",1],["one ["two'), ("user", "three")]


def test_references(spark):
    cases = {
        "a &#9999999; b &#xFFFFFF; &#0; &#xD800; &#00065; &#x1F600; &#99999999999999999999;": "a � b � � � A 😀 �",
        "&eacute; &rarr; &bull; &amp;lt; &unknown; & &; &NotEqualTilde;": "é → • &lt; &unknown; & &; ≂̸",
        "it&#146;s &#128;5 &#129;": "it’s €5 \x81",
    }
    assert many(spark, list(cases), markup.decode_references) == list(cases.values())


def test_pages_lose_no_text(spark):
    text = {
        "<p>a &#9999999; b</p>": "a � b",
        "<!-- <script> --><p>lost text</p><script>x</script><p>k</p>": "lost text\nk",
        '<p title="a>b">x</p>': "x",
        "<p>a<script>var s='</p>'": "a",
        '<p title="a>b</p>': "b",
    }
    assert many(spark, list(text), markup.visible_text) == list(text.values())
    page = "<div>Hello title</div><div>Model</div><div>Hi there</div><div class='x'>User</div><section>Bye</section>"
    shown = one(spark, page, markup.markdown)
    assert shown.split("\n\n") == ["Hello title", "Model", "Hi there", "User", "Bye"]
    marked = {
        "<table><tr><td>a</td><td>b</td></tr></table>c<hr>d": "a\n\nb\n\nc\n\nd",
        "<img alt='cat' src=c.png><img src=\"d.png\"><img src='e.png' alt=dog>": "![cat](c.png)![](d.png)![dog](e.png)",
        "<a href='u'>one</a> <a name=x>two</a> <a class=k href=v>three</a> <a href=w>open": "[one](u) two [three](v) open",
        "<b class='k'>bold</b><br/>x": "**bold**  \nx",
    }
    assert many(spark, list(marked), markup.markdown) == list(marked.values())
    turns = spark.createDataFrame([(1, page)], "page_id long, html string")
    made = [(r.role, r.text) for r in extract.extract_heading_pages(turns, ["page_id"]).orderBy("turn").collect()]
    assert made == [("user", "Hello title"), ("assistant", "Hi there"), ("user", "Bye")]


def test_text_blocks_name_the_element_around(spark):
    page = (
        '<p class="c">short <b>bold</b> this tail text is much longer than it</p>'
        "<div class=d>before the break it is long<br>and after the break as well<p>inner one is long enough too</div>"
        "no element is around this text at all</i>"
    )
    said = [
        ("p", "c", "this tail text is much longer than it"),
        ("div", "d", "before the break it is long"),
        ("div", "d", "and after the break as well"),
        ("p", None, "inner one is long enough too"),
    ]
    assert [tuple(b) for b in one(spark, page, markup.text_blocks)] == [(t, c, len(x), x) for t, c, x in said]


def test_markup(spark):
    html = (
        "<!DOCTYPE html><html><head><title>A &amp; B</title><style>p{}</style></head><body><nav>no</nav>"
        "<h2>H</h2><p>one<!-- c --><b>two</b> &#20320;&#x597d; &copy;<script>var x='</p>'</script></p>"
        "<p class=\"c1\">a paragraph long enough to show</p><a href=\"/l\">L</a><img src=\"i.png\"><footer>no</footer></body></html>"
    )
    assert one(spark, html, markup.title) == "A & B"
    assert one(spark, "<p>x", markup.title) == "Unknown"
    assert one(spark, "<title></title>", markup.title) is None
    assert one(spark, html, markup.visible_text).split("\n") == [
        "A & B", "H", "one", "two", "你好 ©", "a paragraph long enough to show", "L",
    ]
    shown = one(spark, html, markup.markdown)
    assert "## H" in shown and "**two**" in shown and "[L](/l)" in shown and "![](i.png)" in shown
    assert [tuple(b) for b in one(spark, html, markup.text_blocks)] == [("p", "c1", 31, "a paragraph long enough to show")]


def test_page_extractor_order(spark):
    state = '{"p":{"mapping":{"1":{"message":{"author":{"role":"user"},"content":{"parts":["a",1,"b"]}}},"2":{"x":1}}}}'
    page = lambda s: f'<body><p>User: shown</p><script id="__NEXT_DATA__">{s}</script></body>'
    rows = [(0, page(state)), (1, page('{"messages":[{"role":"user","content":"c"}]}')), (2, "<p>nothing here</p>")]
    df = spark.createDataFrame(rows, "doc_id long, html string")
    made = sorted((r.doc_id, r.method, r.role, r.text) for r in extract.extract_precedence(df, ["doc_id"]).collect())
    assert made == [(0, "state", "user", "ab"), (1, "labels", "user", "shown")]
    left = extract.quarantine(extract.page_turns(df), ["doc_id"], F.col("html"), F.lit("web")).collect()
    assert [(r.doc_id, r.raw_dump, r.source) for r in left] == [(2, "<p>nothing here</p>", "web")]


def test_prompts(spark):
    def shown(column):
        df = spark.createDataFrame([("q", "", "a"), ("q", "in", "a")], "instruction string, input string, output string")
        return [r.x for r in df.select(column(F.col("instruction"), F.col("input"), F.col("output")).alias("x")).collect()]

    assert shown(lambda i, n, o: prompts.inst(i, n)) == ["[INST] q [/INST]", "[INST] q\nin [/INST]"]
    assert shown(prompts.sections)[1] == "### 指令：q\n### 输入：in\n### 响应：a"
    plain = "<|start_header_id|>user<|end_header_id|>\n\nq<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\na<|eot_id|>\n"
    assert shown(prompts.header_plain)[0] == plain
    assert shown(lambda i, n, o: prompts.inst_sys(i, F.lit(""), n, "S")) == [
        "[INST] <<SYS>>\nS\n<</SYS>>\n\nq [/INST]",
        "[INST] <<SYS>>\nS\n<</SYS>>\n\nq\n\n补充信息：in [/INST]",
    ]
    assert [tuple(m) for m in shown(prompts.messages)[1]][1:] == [("user", "q\nin"), ("assistant", "a")]


def test_content_chars(spark):
    import unicodedata

    # characters whose category has not changed between Unicode versions
    old = unicodedata.ucd_3_2_0
    every = [chr(i) for i in range(1, 0x3100) if old.category(chr(i)) == unicodedata.category(chr(i)) != "Cn"]
    text = "a".join(every)
    want = "".join(c for c in text if not c.isspace() and not unicodedata.category(c).startswith("P"))
    assert one(spark, text, script.content_chars) == want


@pytest.mark.parametrize("work", [0, 200])
def test_latin_runs_one_by_one_and_by_automaton(monkeypatch, work):
    """Both ways give what taking one run after another out of the text gives, with few and with very many runs."""
    monkeypatch.setattr(script, "WORK", work)
    left, rng = script._latin_runs_out(), random.Random(5)
    for n in [*range(60), 400]:
        text = "".join(rng.choice("ababcAé你") for _ in range(n * 2))
        rest = text
        for run in re.findall("[A-Za-z]+", text):
            rest = rest.replace(run, "")
        assert sorted(left(text)) == sorted(rest)


def test_the_share_gate_counts_content_only_where_it_decides(spark):
    """Texts under, at and over the gate, with none of the script, and without content, give what the share gives."""
    texts = ["你" * h + "a" * a + p for h in range(4) for a in range(6) for p in ("", " ,.;", "!" * 9)] + ["", "\x01", "☃", "你(a", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = F.coalesce(script.script_share(F.col("t")) >= script.GATE_SHARE, F.lit(True))
    got = df.select("t", script._share_reached(F.col("t"), script.HAN).alias("got"), want.alias("want")).collect()
    assert all(r.got == r.want for r in got if r.t is not None)


def test_terms_are_formatted_whatever_bracket_opens_them(spark):
    texts = ["ab(x)", "ab（x)", "ab(x", "ab x）", "a(b(c)", "你（好）", "", None]
    assert many(spark, texts, T.format_terms) == ["ab（x）", "ab（x）", "ab(x", "ab x）", "a（b(c）", "你（好）", "", None]


# ---- what makes a text or a document is worked out once


def test_hidden_parts_are_found_by_steps(spark):
    rng = random.Random(11)
    parts = ["<script>", "<SCRIPT a='>'>", "</script >", "</scrip", "<nav b>", "</nav>", "<!--", "-->", "<", "</", ">", "x", "\n", "<style", "é"]
    pages = ["".join(rng.choices(parts, k=rng.randrange(14))) for _ in range(1500)]
    for tags in (markup.HIDDEN_TAGS, ("head", "script", "style")):
        slow = many(spark, pages, lambda v, tags=tags: F.regexp_replace(v, markup.hidden_pattern(tags), "\n"))
        assert many(spark, pages, lambda v, tags=tags: markup._without_hidden(v, tags)) == slow


def test_state_ends_at_the_first_end_tag(spark):
    rng = random.Random(12)
    lazy = r"(?is)<script[^>]*\bid=[\x22\x27]__NEXT_DATA__[\x22\x27][^>]*>(.*?)</script\s*>"
    parts = ['<script id="__NEXT_DATA__">', "<Script x id='__next_data__' y>", "</script>", "</SCRIPT\n>", "</scrip", "<", ">", "{}", "\n"]
    pages = ["".join(rng.choices(parts, k=rng.randrange(9))) for _ in range(1500)]
    want = many(spark, pages, lambda v: F.regexp_extract(v, lazy, 1))
    assert many(spark, pages, lambda v: F.regexp_extract(v, extract.STATE_SCRIPT, 1)) == want


def test_texts_are_made_once(spark):
    df = spark.createDataFrame([("x",)], "v string")
    plan = lambda c: df.select(c.alias("c"))._jdf.queryExecution().analyzed().toString()
    made = F.regexp_replace("v", "made here", "")
    assert plan(markup.decode_references(made)).count("made here") == 1
    assert plan(jsonwalk.find_messages(made)).count("made here") == 1
    assert plan(jsonwalk.find_conversation(made)).count("made here") == 1
