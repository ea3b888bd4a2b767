import random

import public_tokenizers
from tokenizers import Tokenizer

from lakemill.llm import edit_counts as ec
from lakemill.llm.bpe import Vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = ["a", "B", "é", " ", " ", "\n", "\t", "1", "½", "'s", "'re", "'", "!", "😀", "　", "the", " The", "<|endoftext|>", "\x1c"]


def tree_of(text, pattern, counter):
    return ec.DocumentTree.of_text(text, pattern, counter)


def text_of(tree):
    return "".join(tree.leaf(i).text for i in range(len(tree.leaves)))


def test_trees_equal_recount():
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    pattern, counter = ec.Pretokens(ec.pretoken_pattern(), ec.pretoken_pattern(True)), ec.Counter(Vocabulary.load(PATH))
    r = random.Random(3)
    for n in [0, 1, 2, 5, 30, 200, 3000]:
        for _ in range(12):
            text = "".join(r.choice(ALPHABET) for _ in range(n))
            tree = tree_of(text, pattern, counter)
            for _ in range(12):
                where, delete, insert = r.randint(-2, len(text) + 3), r.choice([0, 0, 1, 3, 40, 900]), "".join(r.choice(ALPHABET) for _ in range(r.choice([0, 1, 4, 60, 700])))
                tree.edit(where, delete, insert)
                at = min(max(0, where), len(text))
                text = text[:at] + insert + text[at + delete :]
                assert text_of(tree) == text
                assert tree.tokens == len(library.encode(text, add_special_tokens=False).ids)
                assert [x for i in range(len(tree.leaves)) for x in tree.leaf(i).lengths] == [*map(len, pattern.full(text))]
                assert tree.characters == len(text) and tree.pretokens == len(pattern.full(text))


def test_only_the_region_is_encoded_again():
    pattern, counter = ec.Pretokens(ec.pretoken_pattern(), ec.pretoken_pattern(True)), ec.Counter(Vocabulary.load(PATH))
    tree = tree_of("some words and more " * 5000, pattern, counter)
    tree.edit(50_000, 3, "x y z")
    assert 0 < tree.encoded < 12


def test_kept_trees_are_edited_again_without_their_texts(spark, tmp_path):
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    r = random.Random(9)
    texts = {i: "".join(r.choice(ALPHABET) for _ in range(n)) for i, n in enumerate([0, 3, 400, 60_000, 90_000])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    trees = ec.build_trees(docs, PATH)
    for run in range(3):
        path = f"{tmp_path}/{run}"
        trees.write.parquet(path)
        edits = [(i, s, r.randint(0, len(t)), r.choice([0, 2, 9]), r.choice(["", "new words", "x", " " * 300, "y z" * 200])) for i, t in texts.items() for s in range(2)]
        for i, _, at, delete, insert in edits:
            at = min(at, len(texts[i]))
            texts[i] = texts[i][:at] + insert + texts[i][at + delete :]
        table = spark.createDataFrame(edits, "doc_id long, seq int, start long, delete long, insert string")
        trees = ec.apply_edits(ec.with_edits(spark.read.parquet(path), table), PATH)
        got = {x.doc_id: x for x in trees.collect()}
        for i, t in texts.items():
            assert got[i].n_tokens_after == len(library.encode(t, add_special_tokens=False).ids)
            assert "".join(got[i].texts) == t and got[i].n_characters == len(t)
            assert got[i].n_read < 6_000  # of up to 90,000


def test_operator(spark):
    rows = [(1, "Hello world", [(0, 5, "Bye")], 5), (2, None, [(3, 1, "new text")], 5), (3, "", None, 5), (None, "x y", [None, (None, None, None)], 5), (1, "Hello world", [], 5)]
    df = spark.createDataFrame(rows, f"doc_id long, text string, edits {ec.EDITS}, n_tokens int")
    got = sorted(map(tuple, ec.edit_counts(df, PATH).collect()), key=str)
    assert got == sorted([(1, 2, 2, 1, 1, 2, 3), (2, 0, 0, 1, 2, 2, 2), (3, 0, 0, 0, 0, 0, 0), (None, 2, 2, 2, 0, 2, 2), (1, 2, 2, 0, 0, 2, 2)], key=str)
    assert ec.edit_counts(df.limit(0), PATH).count() == 0
    table = spark.createDataFrame([(1, 1, 0, 5, "Bye"), (1, 2, 0, 0, "A ")], "doc_id long, seq int, start int, delete int, insert string")
    more = ec.edit_counts(ec.with_edits(df.drop("edits"), table), PATH).where("doc_id = 1").collect()
    assert [r.n_edits for r in more] == [2, 2]
