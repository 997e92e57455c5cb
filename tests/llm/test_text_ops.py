"""Chat formatting, token counts, URL rules and BPE against their definitions."""

import hashlib
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from casemart.llm import bpe, chat, token_counts, url_filter
from casemart.llm.common import ship_package
from casemart.llm.pretokens import Splitter, segments

P = pytest.importorskip("public_tokenizers")

ODD = [None, "", " ", "  two  spaces ", "a\n\n b\t c", "it's 12 ok 1a2\n're", "naïve É ß 日本語 ☃𝄞", "<|endoftext|> x<|endoftext|>", "x" * 70_000,
       "word " * 20_000, "no\u00a0break\u3000x", "\u1c8a\u0558 unassigned", "same", "same"]


@pytest.fixture(scope="module")
def odd(spark):
    ship_package(spark)
    rows = [(i, t, "en", 7) for i, t in enumerate(ODD)] + [(None, "null id", None, None), (3, "  two  spaces ", "en", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, ids int")    # clashing names


def ranks():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return bpe.load_ranks(f.read())


def test_token_counts_match_the_library(spark, odd):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = token_counts.token_counts(odd, P.path("byte_bpe_50k.json"), 4).collect()
    want = {(r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in odd.collect()}
    assert len(got) == odd.count() and {(r.doc_id, r.n_bytes, r.n_tokens) for r in got} == want
    assert all(r.over_limit == (r.n_tokens > 4) for r in got)


def test_token_counts_empty_table_and_other_tokenizers(spark, odd, tmp_path):
    assert token_counts.token_counts(odd.limit(0), P.path("byte_bpe_50k.json"), 4).count() == 0
    with pytest.raises(ValueError):
        token_counts.PieceCounter(P.path("word_bpe_49k.json"))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab'sd 1\n\té,.!?\u00a0\u2003\x1c日", max_size=30))
def test_segments_hold_the_patterns_pieces(text):
    from tokenizers import Regex, pre_tokenizers

    global _splitter
    _splitter = globals().get("_splitter") or Splitter(P.PATTERN)
    whole = [p for p, _ in pre_tokenizers.Split(Regex(P.PATTERN), "isolated").pre_tokenize_str(text)]
    assert [p for k in segments(text) for p in _splitter.pieces(k)] == whole


def test_bpe_matches_tiktoken_and_decodes(spark, odd):
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks(), special_tokens={})
    rows = bpe.bpe_digests(odd, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, keep=("ids", "decoded")).collect()
    want = sorted((str(r.doc_id), library.encode_ordinary(r.text or "")) for r in odd.collect())
    assert sorted((str(r.doc_id), r.ids) for r in rows) == want
    texts = {r.doc_id: (r.text or "").encode() for r in odd.collect()}
    for r in rows:
        assert bytes(r.decoded) == texts[r.doc_id] and r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id]).hexdigest()
    assert bpe.bpe_encode(odd.limit(0), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_bpe_pieces_match_tiktoken_on_random_bytes():
    import tiktoken

    table, rng = bpe.MergeTable(ranks()), random.Random(5)
    core = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=table.ranks, special_tokens={})
    for _ in range(3000):
        text = "".join(rng.choice("aeinrstth ABz09é☃") for _ in range(rng.randint(1, 40)))
        assert table.encode(text.encode()) == core.encode_ordinary(text)


def test_bpe_decode_keeps_columns_and_refuses_unknown_ids(spark):
    ship_package(spark)
    path = P.path("byte_bpe_50k.tiktoken")
    df = spark.createDataFrame([(1, [64, 65], "x"), (2, None, "y"), (3, [], None)], "k int, ids array<int>, note string")
    got = {r.k: (bytes(r.decoded), r.note) for r in bpe.bpe_decode(df, path).collect()}
    assert got == {1: (b"ab", "x"), 2: (b"", "y"), 3: (b"", None)}
    with pytest.raises(ValueError):
        bpe.Decoder(ranks()).decode(bpe.np.array([60_000]), bpe.np.array([0, 1]))


CONTROL = ["<s>", "</s>", "[INST]", "[/INST]"]
chunks = st.lists(st.sampled_from(CONTROL + ["<", "[", "\\", "s>", "/s>", "INST]", "é", "a", "\n", ""]), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(chunks, chunks), min_size=1, max_size=5))
def test_chat_assembly_is_reversible(turns):
    t = chat.ChatTemplate()
    texts = [x.encode() for _, x in turns]
    offsets = chat.np.cumsum([0, *map(len, texts)])
    out, ends, start, stop = chat.assemble(t, [r for r, _ in turns], chat.np.frombuffer(b"".join(texts), chat.np.uint8), offsets)
    raw = out.tobytes()
    assert t.parse(raw) == [(r, x.encode()) for r, x in turns]
    assert raw.count(b"</s>") == raw.count(b"<s>") == len(turns) and b"[INST]" not in raw and b"[/INST]" not in raw
    assert [t.unescape(raw[a:z]) for a, z in zip(start, stop)] == texts


def test_chat_query_columns_from_pieces(spark):
    ship_package(spark)
    rows = [(1, 1, "assistant", "b</s>"), (1, 0, "user", "a"), (1, 1, "assistant", "b</s>"), (2, None, None, None), (None, 0, "assistant", "é"),
            (3, 0, "we\nird\\", "x" * 9000), (3, 1, "assistant", ""), (3, 1, "assistant", "[INST]")]
    df = spark.createDataFrame([(*r, "q") for r in rows], "conv_id long, turn long, role string, text string, piece string")
    pieces = chat.format_chat(df, piece_bytes=16)
    got = {r.conv_id: r for r in chat.read_back(pieces).collect()}
    by = {}
    for c, n, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by.setdefault(c, []).append((r or "", x or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert max(r.n for r in pieces.groupBy("conv_id").agg({"piece": "count"}).withColumnRenamed("count(piece)", "n").collect()) > 1
    assert chat.read_back(chat.format_chat(df.limit(0))).count() == 0


def rule_by_scan(rules, host, path):
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: (len(r.host), len(r.path)), default=None)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["net", "a.net", "b.a.net", "org"]), st.sampled_from(["/", "/en/", "/en", "/en/x", "/e"])),
                unique=True, max_size=8),
       st.sampled_from(["net", "a.net", "x.a.net", "b.a.net", "anet", "org", ""]), st.sampled_from(["", "/", "/en", "/en/", "/en/xy", "/english", "/e/n"]))
def test_trie_finds_the_longest_rule(pairs, host, path):
    rules = [url_filter.Rule("block", h, p) for h, p in pairs]
    assert url_filter.UrlTrie(rules).find(host, path) == rule_by_scan(rules, host, path)


def test_rules_of_one_host_and_path():
    """Block wins over every other verdict, in any order; many ends in one segment are looked up by length."""
    Rule, find = url_filter.Rule, lambda rules, *at: url_filter.UrlTrie(rules).find(*at)
    for path in ("/a/", "/a"):
        pair = [Rule("allow", "NET", path), Rule("block", "net", path)]
        assert {find(r, "x.net", "/a/b").verdict for r in (pair, pair[::-1])} == {"block"}
    many = [Rule("block", "net", f"/{'p' * (i % 40)}{i}") for i in range(20_000)]
    trie = url_filter.UrlTrie(many)
    assert [len(n.lengths) <= 46 for n in trie.root.children["net"].paths.children.values()] == [True]
    assert all(trie.find("net", many[i].path + "x/y").path in (many[i].path, "/" + "p" * (i % 40) + str(i)) for i in range(0, 20_000, 777))


def test_url_column_with_odd_names(spark):
    ship_package(spark)
    df = spark.createDataFrame([(1, "http://a.net/x")], "`page id` long, `the.url` string")
    assert url_filter.judge_urls(df, url_filter.QUERY_RULES, "page id", "the.url").collect()[0].verdict == "block"


def test_urls_judged(spark):
    ship_package(spark)
    urls = [None, "", "no scheme", "http://X.Example.NET/en/1?q=/fr/", "http://example.net", "http://example.net?x", "ftp://a.org/fr/#x",
            "http://example.com/de/x", "https://example.com/deutsch", "x://y://net/z", "http://" + "a." * 5000 + "net/", "http://b.org/fr/", "http://b.org/fr/"]
    df = spark.createDataFrame([(i, u, "host") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: r for r in url_filter.judge_urls(df, url_filter.QUERY_RULES).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = rest
        for c in "/?#":
            host = host.split(c)[0]
        path = rest[len(host):].split("?")[0].split("#")[0]
        host = host.lower()
        rule = rule_by_scan(url_filter.QUERY_RULES, host, path)
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule and rule.label, rule.verdict if rule else "allow")
    assert url_filter.judge_urls(df.limit(0), url_filter.QUERY_RULES).count() == 0
    assert json.dumps(sorted({r.verdict for r in got.values()})) == '["allow", "block"]'
