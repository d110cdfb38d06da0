"""Four small texts with known reports."""

import pytest

from lexiband.operators.bands import letter_bands, word_bands
from lexiband.operators.frequency import corpus_totals
from lexiband.plans.report import write_report
from lexiband.sources.csv import read_bands
from lexiband.sources.tables import read_lines

# Input text; total words, distinct words, word limits, distinct letters,
# letter limits; then the word and letter rows of the popular, common and rare bands.
GOLDENS = {
    "a": (
        "Apache Spark is an open-source distributed general-purpose cluster-computing framework. Originally "
        "developed at the University of California, Berkeley's AMPLab, the Spark codebase was later donated to "
        "the Apache Software Foundation, which has maintained it since. Spark provides an interface for "
        "programming entire clusters with implicit data parallelism and fault tolerance.\n",
        (51, 45, 3, 21, 24, 42, 22, 2, 10, 12, 20),
        (
            "1 spark 3, 2 the 3, 3 an 2",
            "21 framework 1, 22 general 1, 23 has 1, 24 implicit 1",
            "42 university 1, 43 was 1, 44 which 1, 45 with 1",
        ),
        ("1 e 36, 2 a 35", "10 p 15, 11 c 13, 12 d 12", "20 b 4, 21 v 3, 22 y 3"),
    ),
    "b": (
        "a@b fr45 hh fr hh\n\nhgb,jk.io oo. 1.233.4\n\nhh kkk y65 [9'       hh\nhh \n\n\n"
        'blue,red,green.\nblue.red.green.\nblue{red}green.\nblue"red"green.\nblue;red;green.\nblue(red)green.\n'
        "\nhh\n\nwhen we talk about theses problems we mean: 1) abc, bbc, cbs.\n"
        "(all of you), {usa, uk, uae}.  \n\n\n\n\n\n",
        (47, 26, 2, 12, 14, 24, 22, 2, 10, 12, 20),
        ("1 blue 6, 2 green 6", "12 hgb 1, 13 io 1, 14 jk 1", "24 usa 1, 25 when 1, 26 you 1"),
        ("1 e 32, 2 h 15", "10 o 7, 11 d 6, 12 k 6", "20 i 1, 21 j 1, 22 p 1"),
    ),
    "c": (
        "Kubernetes is an open-source system for automating deployment, scaling, and management of containerized "
        "applications.\nKubernetes KuberneteS Kuber5netes kubernetes Kubernetes7 KuberneTes\n"
        "SystEM Sys System. system, sYstem> >>> 8765 Kubernetes@Kubernetes.com applications. applications "
        "(applications,applications)++({applications})\n{PPP} {nnb}\n"
        "gg hh jj k mmm iii yyy vv ccc ff rr eee ss dd rrr tttt yy tt tt ttt uu iii www qqq aa ww33 ee ddd cc vvb nn\n",
        (61, 47, 3, 22, 25, 44, 25, 2, 11, 14, 23),
        (
            "1 applications 6, 2 kubernetes 5, 3 system 4",
            "22 hh 1, 23 is 1, 24 jj 1, 25 k 1",
            "44 vvb 1, 45 www 1, 46 yy 1, 47 yyy 1",
        ),
        ("1 e 45, 2 t 36", "11 m 13, 12 u 13, 13 y 12, 14 b 11", "23 h 2, 24 j 2, 25 z 1"),
    ),
    "e": (
        "pp p$ p% p^ p& p+ p= 32a ab ab bb@ 76  £ff qqq q@ q! 543 'khhh j'\n"
        "qq pP ab ab AB  abcd cdba ABCD ab$cd  877 97 Fr44 AB AB pp qqq \n",
        (17, 7, 1, 3, 4, 6, 11, 1, 5, 6, 10),
        ("1 ab 7", "3 abcd 2, 4 qqq 2", "6 q 1, 7 qq 1"),
        ("1 b 13", "5 c 4, 6 d 4", "10 k 1, 11 r 1"),
    ),
}


def rows_of(bands):
    rows = []
    for name, band in zip(("popular", "common", "rare"), bands):
        for row in band.split(", "):
            rank, token, frequency = row.split()
            rows.append((int(rank), token, name, int(frequency)))
    return rows


@pytest.fixture(params=sorted(GOLDENS))
def golden(request, tmp_path):
    text, totals, words, letters = GOLDENS[request.param]
    path = tmp_path / f"sample-{request.param}.txt"
    path.write_bytes(text.encode("utf-8"))
    return str(path), totals, rows_of(words), rows_of(letters)


def test_totals(spark, golden):
    path, totals, _, _ = golden
    assert corpus_totals(read_lines(spark, path), "value").collect() == [totals]


def test_bands(spark, golden):
    path, _, words, letters = golden
    lines = read_lines(spark, path)
    assert word_bands(lines, "value").orderBy("rank").collect() == words
    assert letter_bands(lines, "value").orderBy("rank").collect() == letters


def test_report(spark, golden, tmp_path):
    path, _, words, letters = golden
    words_out, letters_out = write_report(spark, path, str(tmp_path / "out"))
    assert read_bands(spark, words_out, "word").orderBy("rank").collect() == words
    assert read_bands(spark, letters_out, "letter").orderBy("rank").collect() == letters
