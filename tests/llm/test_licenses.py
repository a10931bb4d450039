from strata.llm import licenses

MIT = licenses.TEXTS["MIT"]
CASES = [
    (1, "Copyright (c) 2021 Some One\nAll rights reserved.\n\n" + MIT, "MIT", ""),
    (2, MIT.upper().replace('"', "“").replace(",", " ,"), "MIT", ""),
    (3, MIT.replace("sublicense", "sub-licence").replace("COPYRIGHT HOLDERS", "copyright owners"), "MIT", ""),
    (4, MIT + "\nbut not on Sundays", None, ""),
    (5, "prose\nReleased under the MIT Licence.\nmore\nLicensed under CC BY-NC 4.0", None, "CC-BY-NC-4.0,MIT"),
    (6, None, None, ""), (7, "", None, ""), (7, "", None, ""), (None, "licensed under cc by 4.0", "CC-BY-4.0", "CC-BY-4.0"),
    (8, "...\n!!!", None, ""), (9, "word " * 40_000, None, ""),
]


def test_cases(spark):
    df = spark.createDataFrame([(d, t, "x") for d, t, *_ in CASES], "doc_id long, text string, license_id string")
    got = licenses.scan(df, licenses.known_table(spark)).collect()
    assert sorted(((r.doc_id, r.license_id, r.notice_ids) for r in got), key=repr) == sorted(
        ((d, k, n) for d, _, k, n in CASES), key=repr)
    assert all((r.digest is None) == (r.doc_id == 6) for r in got)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    none = spark.createDataFrame([], "license_id string, text string")
    assert licenses.scan(docs, licenses.known_table(spark)).count() == 0
    some = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert [(r.license_id, r.notice_ids) for r in licenses.scan(some, none).collect()] == [(None, "")]


def test_standard_files(spark):
    apache, gpl = (next(t for k, t in licenses.known_licenses() if k == n and "How to" * (n[0] == "G") in t and len(t) > 11_000)
                   for n in ("Apache-2.0", "GPL-3.0"))
    bsd3 = licenses.TEXTS["BSD-3-Clause"]
    cases = [
        ("MIT License\n\nCopyright (c) 2020 X\n\n" + MIT, "MIT"),
        ("The MIT License (MIT)\n\nCopyright (c) <year> <copyright holders>\n\n" + MIT, "MIT"),
        ("MIT License\n\nCopyright (c) Some Company, Inc. and its affiliates.\n\n" + MIT, "MIT"),
        ("BSD 3-Clause License\n\nCopyright (c) 2019, X\nAll rights reserved.\n\n" + bsd3, "BSD-3-Clause"),
        (licenses.TEXTS["BSD-2-Clause"].replace("1. ", " - ").replace("2. ", " - "), "BSD-2-Clause"),
        (licenses.TEXTS["Unlicense"].replace("http:", "https:"), "Unlicense"),
        (apache.replace("[yyyy] [name of copyright owner]", "2021 X"), "Apache-2.0"), (gpl, "GPL-3.0"),
        (MIT.replace("free of charge", "for a fee"), None), ("MIT License", "MIT"),
        ("prose about a copyright (c) of others", None),
    ]
    for k in licenses.FILES:
        with open(f"{licenses.__file__.rsplit('/', 1)[0]}/license_texts/{k}.txt", encoding="utf-8") as f:
            cases.append((f.read(), k))
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: (r.license_id, r.notice_ids) for r in licenses.scan(df, licenses.known_table(spark)).collect()}
    assert [got[i][0] for i in range(len(cases))] == [k for _, k in cases]
    assert got[0][1] == "MIT" and got[9][1] == "MIT"
