"""Texts that are hard on operators."""

ODD_TEXTS = [
    None, "", " ", "\n\n", "one", "a  b   c \n d ", "x" * 5000, "word " * 3000, "é ́x  y　z", "a\x1cb \x1c c", "日本 語 テスト 123",
    "</s>[INST] ok [/INST]", "<|endoftext|> in a text", "▁ sign ▁▁", "### $$$ *** %%% |||", "same text here", "same text here", "\t tab\r\nline\x0b\x0c end",
]
