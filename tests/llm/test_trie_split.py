"""op7's splits by ``re`` are those of the vocabulary's pattern, and its tokens
those of the library."""

import random

import regex

from tracelens.llm.trie_bpe import SPLIT_PATTERN, bpe_of, byte_bpe_path


def test_splits_and_tokens_of_odd_texts():
    from tokenizers import Tokenizer

    bpe, whole = bpe_of(byte_bpe_path()), Tokenizer.from_file(byte_bpe_path())
    assert bpe.find_ascii.__self__.pattern != bpe.find_wide.__self__.pattern
    rnd, find = random.Random(4), regex.compile(SPLIT_PATTERN).findall
    plain = [chr(i) for i in range(128)] + ["'s", "'ll", "  ", "\n "]
    narrow = plain + list("\x85\xa0\u1680\u2003\u2028\u3000\ufeff\xb2\xbd\u0663\u2167\u0301\u0e33\u6f22\uac00\u01c5")
    wide = narrow + ["\U0001f600", "\U00010400", "\U0001d7d8"]
    for chars in (plain, narrow, wide):
        for _ in range(300):
            text = "".join(rnd.choices(chars, k=rnd.randrange(60)))
            assert bpe.find(text) == find(text), ascii(text)
            assert bpe.encode(text) == whole.encode(text, add_special_tokens=False).ids, ascii(text)
    every = "".join(chr(i) for i in range(0x10000) if not 0xD800 <= i < 0xE000)
    assert bpe.find(every) == find(every)
