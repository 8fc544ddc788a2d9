"""op1's word cache: ids as the tokenizer gives them, with a model call per letter run."""

from strata.llm import packing, queries


class _Counted:
    def __init__(self, model):
        self.model, self.calls = model, 0

    def tokenize(self, text):
        self.calls += 1
        return self.model.tokenize(text)


def test_a_letter_run_is_worked_out_once_whatever_case_and_symbols_it_comes_in():
    words = packing.WordIds(queries.tokenizer_file("word_bpe_49k.json"))
    words.model = _Counted(words.model)
    odd = ["rentre", "Rentre", "RENTRE.", "rentre,", "rentre***", "Rentre&&&.", "rentre2", "rentre<|endoftext|>", "été.",
           "Été", "don't", "DON'T.", "été.", "ª.", "İ.", "ΣΣ", "中.", "***", "1.5", "'s", "x'S"]
    for text in odd:
        ids = words.whole.encode(text, add_special_tokens=False).ids
        assert list(memoryview(words[text.encode()]).cast("H")) == ids, text
    # rentre, été and the ordinal mark; words that are no such run go through the whole chain
    assert words.model.calls == 3
