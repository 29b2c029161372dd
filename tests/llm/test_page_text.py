from __future__ import annotations

import random

from stockflow.llm import page_text as T


def texts(source, states=(T.OPEN, T.KEEP)):
    return [text for text, state in T.blocks(source) if state in states]


def test_blocks_of_a_page():
    source = (
        '<html><head><title>x</title><style>p{}</style></head><body class="home"><header>H</header>'
        "<div id=main-menu><ul><li>a<li>b</ul></div><div class='content'><h1>T</h1><p>One&nbsp;two<p>Three <b>four</b><br>"
        'five <span class=share>share</span>end <svg><g>q</g></svg>z<div class="sidebar-box">S</div><div>six</div></div>'
        "<div class=comments><p>c1</div><form>f<input></form><footer>F</footer><script>var x='<p>z</p>'</script><!-- c --> tail"
    )
    assert texts(source) == ["T", "One two", "Three four five end z", "six", "tail"]


def test_articles_and_odd_markup():
    assert texts("<article><header><h1>T</h1></header><p>a<aside>x</aside><p>b<form>f</form></article><p>out", (T.KEEP,)) == ["T", "a", "b"]
    assert texts("a < b &amp; <b>c</b>\t d</p>e<p") == ["a < b & c d", "e"]
    assert texts("<p>x &lt;i&gt; &#233; &unknown; &amp") == ["x <i> é &unknown; &"]
    assert texts("<script>never closed <p>x") == [] and texts("") == [] and texts("<!-- open") == []
    assert texts("<div hidden>x</div><div aria-hidden=true>y</div><div role=navigation>z</div>w") == ["w"]


def page(k, body):
    return f"<body><div class=box>{body}</div></body>"


NOTICE = "this site uses many small files to remember what you like best"


def test_what_a_host_repeats_goes(pages):
    rows = [(k, f"http://h.example/{k}", page(k, f"<p>{NOTICE}</p><p>own{k} text of page number{k}</p><p>{NOTICE} more{k}</p>")) for k in range(6)]
    rows += [(10 + k, f"http://o.example/{k}", page(k, f"<p>{NOTICE}</p>")) for k in range(2)]
    rows += [(20, "http://h.example/z", f"<article><p>{NOTICE}</p></article><p>beside"), (21, None, None), (22, "x", ""), (None, "y", "<p>null id")]
    rows += [(0, *rows[0][1:])]
    found = {}
    for row in T.extract(pages(rows)).collect():
        found.setdefault(row["id"], []).append(row["text"])
    assert found[3] == ["own3 text of page number3\n\nmore3"]
    assert found[0] == ["own0 text of page number0\n\nmore0"] * 2
    assert found[10] == [NOTICE] and found[20] == [NOTICE]
    assert found[21] == [""] and found[22] == [""] and found[None] == ["null id"]


def test_covered_tokens_match_brute_force():
    a = [f"t{k}" for k in range(40)]
    keys = T.suffix_heads([a, a[5:30], ["x", *a[10:25], "y"], a[:7]])
    assert [len(k) for k in keys] == [33, 18, 10, 0]
    shared = set(keys[0].tolist()) & set(keys[2].tolist())
    text = T.unique_text([" ".join(["x", *a[10:25], "y"])], [T.OPEN], keys[2], shared)
    assert text == "x y"


def test_an_empty_table_has_no_rows(pages):
    assert T.extract(pages([])).collect() == []


def test_hosts(llm):
    frame = llm.createDataFrame([("http://U:p@A.b:80/x",), ("https://c.d?x",), ("nothing",), (None,)], "u string")
    assert [r[0] for r in frame.select(T.host(frame["u"])).collect()] == ["a.b", "c.d", "nothing", None]


def test_class_words_and_forms_do_not_take_the_article_along():
    for source in (
        "<main class='content no-sidebar'><p>a b</p></main>",
        "<div class='layout has-sidebar'><main><p>a b</p></main><div class=sidebar>x</div></div>",
        "<article class='post comments-open'><p>a b</p></article><p>beside",
        "<form id=all><div><article><p>a b</p></article></div><input></form>",
        "<div class=sidebar><article><p>a b</p></article></div>",
        "<div class=widget role=article><p>a b</p></div>",
    ):
        assert texts(source, (T.KEEP,)) == ["a b"], source
    assert texts("<article><div class='article-header'><h1>T</h1></div><p>a</article>", (T.KEEP,)) == ["T", "a"]
    assert texts("<form id=all><p>a<p>b<select><option>x</select></form>") == ["a", "b"]
    assert texts("<main><p>a</main><div class=related><article>teaser</article></div><form><p>f</form>") == ["a"]
    assert texts("<nav><article>x</article></nav><p>a") == ["a"]


def test_many_open_elements_take_linear_time():
    source = "<b>" * 40_000 + "x" + "</i>" * 40_000
    assert texts(source) == ["x"]


def test_copies_of_a_page_do_not_erase_it(pages):
    body = page(0, "<p>one two three four five six seven eight nine ten</p>")
    rows = [(k, "http://h.example/copy", body) for k in range(5)]
    rows += [(10 + k, f"http://h.example/{k}", page(k, f"<p>page{k} alone</p>")) for k in range(20)]
    found = {row["id"]: row["text"] for row in T.extract(pages(rows)).collect()}
    assert {found[k] for k in range(5)} == {"one two three four five six seven eight nine ten"}
    assert found[12] == "page2 alone"


def brute(rows):
    """The operator with every suffix pair of a host compared."""
    parsed = []
    for key, url, source in rows:
        held = T.blocks(source or "")
        if any(state == T.KEEP for _, state in held):
            held = [(text, T.DROP if state == T.OPEN else state) for text, state in held]
        parsed.append((key, (url or "").split("/")[2], source, held))
    out = []
    for key, host, _, held in parsed:
        stream = [word for text, state in held if state != T.KEEP for word in text.split()]
        contents = {}
        for _, other_host, source, other in parsed:
            if other_host == host:
                contents[source] = [word for text, state in other if state != T.KEEP for word in text.split()]
        gone = set()
        for at in range(len(stream) - T.DEPTH + 1):
            head = stream[at : at + T.DEPTH]
            on = sum(any(words[k : k + T.DEPTH] == head for k in range(len(words))) for words in contents.values())
            if on >= T.MIN_PAGES:
                gone |= set(range(at, at + T.DEPTH))
        kept, at = [], 0
        for text, state in held:
            if state == T.KEEP:
                kept.append(text)
                continue
            words = text.split()
            left = [word for k, word in enumerate(words) if at + k not in gone]
            at += len(words)
            if state == T.OPEN and left:
                kept.append(" ".join(left))
        out.append((key, "\n\n".join(kept)))
    return sorted(out)


def test_pages_match_brute_force(pages):
    rng = random.Random(6)
    shared = [" ".join(rng.choice("abcdefg") + str(rng.randint(0, 30)) for _ in range(14)) for _ in range(6)]
    rows = []
    for k in range(40):
        parts = [rng.choice(shared) if rng.random() < 0.5 else f"own{k}w{j} " * 9 for j in range(rng.randint(1, 6))]
        body = "".join(rng.choice(["<p>{}</p>", "<div class=menu>{}</div>", "<article>{}</article>", "{}<br>"]).format(p) for p in parts)
        rows.append((k, f"http://h{k % 3}.example/{k}", f"<body>{body}"))
    rows += [(100 + k, *rows[4][1:]) for k in range(4)]
    found = sorted((row["id"], row["text"]) for row in T.extract(pages(rows)).collect())
    assert found == brute(rows)
