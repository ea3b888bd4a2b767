import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakemill.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", "   ", "Hello  wörld it's 123 ΣΑΣ<|endoftext|>abc", "a\x1cb \x85c d", "été I'LL 've ½ ² ١٢ 😀😀 <|startoftext|",
    "İstanbul ǅ ß ͅ ​ x", "naïve " * 500, "A" * 3000, "don't!!! --- #hash @you http://x.y/z?q=1&b=2",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    v = bpe.Vocabulary.load(PATH)
    words = ["hello", "world", "naïve", "the", "there", "then", "x", "hellos"]
    return bpe.Codec(v, bpe.compile_lexicon({w: v.merge(w) for w in words}))


def test_lexicon_finds_its_words_only():
    entries = {w: [i, i + 1] for i, w in enumerate(["a", "abc", "abd", "xbc", "xbd", "é", "zzzz"])}
    lex = bpe.Lexicon(bpe.compile_lexicon(entries))
    assert all(lex.get(w) == ids for w, ids in entries.items())
    assert [lex.get(w) for w in ("ab", "abcd", "", "y", "zz")] == [None] * 5
    shared = bpe.Lexicon(bpe.compile_lexicon({"abing": [1], "xying": [2]}))
    assert len(shared.finals) == 7  # root, a, x and one shared tail
    assert bpe.Lexicon(bpe.compile_lexicon({})).get("a") is None


def test_every_character_like_the_library(codec, library):
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    step = 64
    texts = ["b".join(chars[i : i + step]) + "x" for i in range(0, 0x3400, step)] + ["k".join(random.Random(1).sample(chars, 40)) for _ in range(400)]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert codec.encode(text) == want.ids, text


def test_operator_equals_library(spark, library):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, "none", "x"), (3, TEXTS[3], "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = bpe.bpe_codec(df, PATH, keep_ids=True).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert by[i].ids == ids and by[i].n_tokens == len(ids)
        assert by[i].decoded == library.decode(ids, skip_special_tokens=False)
        assert by[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert by[i].decoded_sha256 == hashlib.sha256(by[i].decoded.encode()).hexdigest()
    assert bpe.bpe_codec(df.limit(0), PATH).count() == 0


def test_other_files_are_refused():
    import copy
    import json

    data = json.load(open(PATH, encoding="utf-8"))
    assert bpe.pretokens_of(data)[0] == "words"
    assert bpe.pretokens_of(json.load(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8"))) == ("bytes", None)

    def changed(**more):
        return copy.deepcopy({k: v for k, v in data.items() if k != "model"}) | {"model": {k: v for k, v in data["model"].items() if k not in ("vocab", "merges")}} | more

    bad = [changed(normalizer={"type": "Lowercase"}), changed(pre_tokenizer={"type": "Whitespace"}), changed(model={"type": "WordPiece"})]
    odd = changed()
    odd["added_tokens"][0]["lstrip"] = True
    bare = changed()
    bare["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = "\\p{L}+"
    for x in (*bad, odd, bare):
        with pytest.raises(ValueError):
            bpe.pretokens_of(x)
