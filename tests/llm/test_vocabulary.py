import numpy as np
import tiktoken
from tokenizers import Tokenizer

from ledgerloom.llm import bpe, vocabulary
from ledgerloom.llm.vocabulary import BYTE_BPE, WordCache, encoded

TEXTS = ["word word. word, (word) word; word! word? word:", "a. b.. .c d.e f.\ng it's. é. ß, 1. x_. end.", "end.", ".", ". .", "A . b", "naïve, 日本. 語 ab."]


def test_marks_against_the_tokenizer():
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    tokenizer.encode_special_tokens = True
    assert [np.frombuffer(ids, "<u4").tolist() for ids in encoded(TEXTS)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in TEXTS]


def test_a_word_is_encoded_once_whatever_mark_follows():
    cache, given = vocabulary._byte_bpe(BYTE_BPE), []

    def encode(text):
        given.append(text)
        return cache.encode(text)

    WordCache(encode, cache.lengths).values_of(["the word word. word, word; word! word? word:"])
    assert sum(text.count("word") for text in given) == 1


LINES = ["a\nb", "a.\n\nB c\n\n\nd", "a \nb", "a\n b", "\na\nb", "a\n", "a\r\nb\r\n\r\nc d", "a\n\tb", "\ta\nb", "a\x85\nb", "a\n \nb", "\n", "it\n's 1\n2.\n."]


def test_lines_against_the_tokenizer():
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    tokenizer.encode_special_tokens = True
    assert [np.frombuffer(ids, "<u4").tolist() for ids in encoded(LINES)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in LINES]


def test_a_word_that_begins_a_line_is_encoded_once_whatever_is_in_front():
    cache, given = vocabulary._byte_bpe.__wrapped__(BYTE_BPE), []
    encode = cache.encode
    cache.encode = lambda text: given.append(text) or encode(text)
    cache.values_of(["some line.\nNext word", "other end\nNext place"])
    assert sum(text.count("Next") for text in given) == 1


def test_lines_stay_together_where_a_pattern_joins_them():
    joining = r"[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"
    codec = bpe.codec(bpe.RANKS, joining)
    ranks = {token: rank for rank, token in enumerate(codec.tokens)}
    other = tiktoken.Encoding("joining", pat_str=joining, mergeable_ranks=ranks, special_tokens={})
    texts = ["one end.\n\nnext word", "two end.\nnext word"]
    assert [ids.tolist() for ids in codec.encode(texts)] == [other.encode_ordinary(t) for t in texts]
