"""Alignments equal a plain byte-by-byte one, with both libraries' own ids."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from explain import SMALL
from tokenizers import Tokenizer

from tallyhouse.llm.packing import byte_level_ranks
from tallyhouse.llm.queries import op11_cross_tokenizer_alignment
from tallyhouse.llm.token_alignment import align_tokens

AWKWARD = [
    "", None, " ", "  a   b ", "a▁b", "<|endoftext|> <s> x</s>", "é Ａ　x​", "日本語のテキスト" * 30, "🙂 🙂🙂",
    "x" * 5_000, "ab cd " * 3_000, "word word", "\x00a\tb\n\n c", "l'été d'où", "a ", "word word",
]


@pytest.fixture(scope="module")
def plain():
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    token = {i: t for t, i in byte_level_ranks(None).items()}

    def piece(i):
        text = second.id_to_piece(i)
        return bytes([int(text[3:-1], 16)]) if second.is_byte(i) else text.replace("▁", " ").encode()

    def one(text):
        if not text:
            return [], [], [], []
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        whole = (" " + text).encode()
        if b"".join(map(token.__getitem__, a)) != whole or b"".join(map(piece, b)) != whole:
            return [], [], [], []
        owners = [[k for k, i in enumerate(ids) for _ in of(i)] for ids, of in ((a, token.__getitem__), (b, piece))]
        links = sorted(set(zip(*owners, strict=True)))
        groups, now = [], ([], [])
        for at in range(len(whole)):
            ends = [at + 1 == len(whole) or side[at] != side[at + 1] for side in owners]
            for side, ids, end, own in zip(now, (a, b), ends, owners, strict=True):
                if end:
                    side.append(ids[own[at]])
            if all(ends):
                groups.append(now)
                now = ([], [])
        return a, b, groups, [(a[x], b[y]) for x, y in links]

    def every(rows):
        aligned = [(i, *one(text)) for i, text in rows]
        count = Counter(pair for *_, links in aligned for pair in set(links))
        best = defaultdict(int)
        for (x, _), n in count.items():
            best[x] = max(best[x], n)
        for i, a, b, groups, links in aligned:
            text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
            digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
            sums = sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links)
            yield (i, len(a), len(b), len(groups), len(links), *sums, digest)

    return every


FIELDS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def got(df):
    return sorted((tuple(r[c] for c in FIELDS) for r in df.select(*FIELDS).collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [200, 1 << 21])
def test_awkward_texts(documents, plain, block_bytes):
    rows = [*enumerate(AWKWARD), (3, "a b"), (3, "a b"), (None, "word")]
    assert got(align_tokens(documents(rows), block_bytes=block_bytes)) == sorted(plain(rows), key=repr)


def test_groups_are_the_ids(documents):
    (row,) = align_tokens(documents([(1, "Hello unbelievable")]), with_groups=True).collect()
    text = ";".join(",".join(map(str, g.a)) + "|" + ",".join(map(str, g.b)) for g in row.groups)
    assert hashlib.sha256(text.encode()).hexdigest() == row.groups_sha256 and len(row.groups) == row.n_groups


def test_empty_table(documents):
    assert align_tokens(documents([])).collect() == []


def test_query(spark, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert got(op11_cross_tokenizer_alignment(spark, SMALL)) == sorted(plain(rows), key=repr)
