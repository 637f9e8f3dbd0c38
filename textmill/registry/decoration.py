"""Replacements that put rare cases into ordinary text, for queries and their SQL."""

from __future__ import annotations

DECORATIONS: dict[str, list[tuple[str, str]]] = {
    "none": [],
    "returns": [("\n", "\r\n"), (" a", " \ra")],
    "signs": [
        (". ", " « . » ❗️❕"),
        (", ", "« ❓‼️ , ❔ »"),
        (" an", " ✖️an✔️ ☺☺️ ☹️☹ ⁉️❗"),
    ],
    "circled": [(". ", "① ⑱"), (", ", " ⑨⑩, ②③④ ")],
    "emoji": [
        (". ", ". 🇫🇷🇪🇸 ❤️❤ 🏳️ 🏳️‍🌈 "),
        (", ", ", 🏴‍☠️🏳️‍⚧️☂️ ♻️⚔️✒️ 🇬🇧"),
    ],
    "unknown": [(". ", "\x01.北\x7f京 é🙂⚡ "), (", ", ",​\tß️€ 🩷🥲 ")],
    "folds": [(". ", "… – ½ ½é "), (", ", " —, ™“x”  𝐀ﬁĳ ")],
    "scripts": [(". ", ". Москва, щука й Αθήνα "), (", ", ", ひらがな カタカナ 한글 값 שלום سلم ")],
    "ideographs": [(". ", "。北京—東京 «中» 🇫🇷 ñ. "), (", ", ", 㐀龥 ❤️ ")],
    "blanks": [(". ", ".  \t\n \n\n\n"), (", ", ",\t\t\n  \n"), (" a", " \t a")],
    "control": [(". ", " <|tab|> .\n<|tab|><|tab|>"), (", ", ", ñ \t\n<|tab|>  ")],
    "some_control": [(" the by ", " <|system|> "), (" de la ", " <|endoftext|>")],
    "spacing": [(". ", " . ( x ) [ y ] "), (", ", " , ,, ")],
    "digits": [(". ", " 1 , 2 , 3 ,\n4. "), (", ", ", 10,  20,30 ,40 , x ")],
    "quotes": [(". ", '." '), (", ", ', "')],
}
DECORATIONS["wiki"] = DECORATIONS["digits"] + [(" 30", '( "30 )'), (" x ", ' "x" ')]
DECORATIONS["everything"] = [
    (". ", "… « . » 🇫🇷❤️ ①  \t\n\n\n\n\x01"),
    (", ", ",\r —ñ 北🏳️ 🏳️‍🌈 ⁉️ß \n"),
]
