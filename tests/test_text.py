import pytest

from quirewise.functions import text as X
from quirewise.operators import metadata as M


def test_normalize(apply):
    values = ["第１２章　まとめ", "a: b", "日本:語", "日,本", "日.本 A.B", "――-あ--い", "Ⅰ部 (x)", " ＳＮＳ ｜親《ルビ》", "a  b", "", "[注]"]
    assert apply(X.normalize, values) == ["第12章まとめ", "a: b", "日本：語", "日、本", "日。本A.B", "――あ――い", "Ⅰ部（x）", "SNS｜親《ルビ》", "a b", "", "〔注〕"]
    assert apply(X.normalize, [None]) == [None]


def test_join_lines(apply):
    lines = [["大きく、20", "15年から"], ["研究所 The Institute", "for Policy"], ["やUA", "Eなど"], ["A2あ", "22", "1あ"], ["", " "], ["『THE", "MODEL』"], []]
    assert apply(X.join_lines, lines, "array<string>") == ["大きく、2015年から", "研究所 The Institute for Policy", "やUAEなど", "A2あ221あ", "", "『THE MODEL』", ""]


def test_heading_level(apply):
    large = ["第1章 x", "第 12 章 まとめ", "第Ⅰ部", "column 3", "終章　親睦", "解説　佐藤太郎", "引用· 参考文献", "はじめに12", "はじめにiii"]
    assert set(apply(X.heading_level, large)) == {"大"}
    assert apply(X.heading_level, ["1-2 節", "終章に向けて", "解説佐藤太郎", "本文"]) == ["中", "小", "小", "小"]


def test_titles(apply):
    assert apply(X.front_back_title, ["あとがき203\n本文", "目次", "序章", "付録1", "解説を書く"]) == ["あとがき", "", "序章", "付録1", ""]
    lines = [["第1章", "題", "副題-"], ["あとがき203"], ["a", "b"], []]
    assert apply(X.heading_title, lines, "array<string>") == ["第1章　題――副題――", "あとがき", "a　b", ""]


@pytest.mark.parametrize(
    ("text", "html"),
    [
        ("2011年", "２０１１年"),
        ("48節", '<span class="tcy">48</span>節'),
        ("2.2人", "２・２人"),
        ("27.8％", '<span class="tcy">27</span>・８％'),
        ("SNS戦略", "ＳＮＳ戦略"),
        ("Web2.0", "Web2.0"),
        ("1.5GB", "1.5GB"),
        ("p.12", 'p.<span class="tcy">12</span>'),
        ("Aさん", "Aさん"),
        ("何！？", '何<span class="tcy">!?</span>'),
        ("！！！", "！！！"),
        ('<img src="../fig02.png"/>', '<img src="../fig02.png"/>'),
        ("<ruby>12<rt>34</rt></ruby>5", "<ruby>12<rt>34</rt></ruby>５"),
        ("", ""),
    ],
)
def test_upright(apply, text, html):
    assert apply(X.upright, [text]) == [html]


def test_ruby(apply):
    ruby = lambda a, b: f"<ruby>{a}<rp>（</rp><rt>{b}</rt><rp>）</rp></ruby>"
    assert apply(lambda c: X.render_inline(c, False), ["｜親《おや》と漢字《かんじ》 & <b>"]) == [ruby("親", "おや") + "と" + ruby("漢字", "かんじ") + " &amp; &lt;b&gt;"]
    assert apply(X.render_plain, ["第12章｜天体《てんたい》の<運行》｜"]) == ["第12章天体の&lt;運行》"]
    assert apply(X.escape_attr, ['a"b&']) == ["a&quot;b&amp;"]


def test_numbers(apply):
    assert [tuple(r) for r in apply(X.roman_value, ["川", "lI", "11", "1", "6", "Ⅲ", "IIIIII"])] == [(3, True), (2, True), (2, True), (1, False), (None, False), (3, True), (None, False)]
    assert apply(X.roman_to_int, ["xiv", "iii", "", "abc", "IX", "xl"]) == [14, 3, None, None, 9, 40]
    assert apply(X.page_set, ["1,10-13, 3", "", "5-4,2"]) == [[1, 3, 10, 11, 12, 13], [], [2]]


def test_isbn(apply):
    values = ["978-4-7664-3020-7", "4-00-310101-4", "ISBN 4003101014", "9784766430200", "12", "", None]
    got = apply(M.normalize_isbn, values)
    assert got[1] == got[2] and got[1].startswith("978400310101") and len(got[1]) == 13
    assert got[3:] == [None, None, None, None]
    assert apply(M.normalize_isbn, [got[1]]) == [got[1]]


def test_authors_and_dates(apply):
    assert apply(M.clean_author, ["中島, 義道, 1946-", "中島,義道,1946-", "平井靖史 編", "Smith, John, 1900-1980", "山田 著 編", "", None]) == ["中島義道", "中島義道", "平井靖史", "Smith John", "山田", "", ""]
    assert apply(M.join_authors, [["甲 著", "乙 訳", "甲", ""]], "array<string>") == ["甲、乙"]
    assert apply(M.format_pubdate, ["199603", "1996-12", "1996", " x ", None]) == ["1996.3", "1996.12", "1996", "x", ""]
