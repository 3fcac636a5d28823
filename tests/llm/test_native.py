"""Edge rows of the operators that are DataFrame functions only."""

import hashlib

from pyspark.sql import Row

from paperloom.llm import license_scan, pii, quality_rules

LONG = " ".join(f"word{i} goes here." for i in range(40))


def test_quality_edges(spark):
    rows = [
        (1, None, 1), (2, "", 1), (3, "a b c a b c", 1), (4, LONG, 1), (4, LONG, 1),
        (5, LONG + "\nHome | About | Contact\nAccept all cookies", 1), (6, "# $ % & " * 60, 1), (7, "x y z " * 400_00, 1), (8, "é\n é\né\n\n \n", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    got = {r.doc_id: r for r in quality_rules.quality_rules(df).collect()}
    assert (got[1].n_words, got[1].kept, got[1].clean_text) == (0, False, "") and not got[2].kept
    assert (got[3].n_words, got[3].n_repeat_words, got[3].word_chars, got[3].base_failed) == (6, 6, 6, True)
    assert got[4].kept and got[4].n_repeat_words == 0 and got[4].clean_text == LONG
    assert got[5].kept and got[5].n_failed_lines == 2 and got[5].clean_text == LONG
    assert got[6].n_symbols == 240 and not got[6].kept
    assert got[7].n_words == got[7].n_repeat_words == 120_000 and got[7].base_failed
    assert got[8].n_dup_lines == 1 and got[8].word_chars == 3
    assert quality_rules.quality_rules(df.limit(0)).count() == 0


def test_pii_spans(spark):
    text = "é a@b.c_d@e.f, 1.2.3.4.5 999.1.1.1 mail: 4111 1111 1111 1111; +1 (437) 555-0689. IBAN GB82 WEST 1234 5698 7654 32 ssn 123-45-6789, x. ssn: 000-11-2222, 333-22-4444 token = \"abcdef0123456789ab\""
    rows = [(1, text, "n"), (2, None, "n"), (3, "", "n"), (4, "x@y.zz " * 3000, "n"), (5, "1" * 60000 + "@" + "a" * 60000, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, pii string")
    got = {r.doc_id: r for r in pii.find_pii(df).collect()}
    found = [(pii.KINDS[s.kind].name, text[s.start : s.stop]) for s in got[1].pii]
    assert found == [
        ("email", "a@b.c"), ("email", "_d@e.f"), ("ip", "1.2.3.4"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (437) 555-0689"),
        ("iban", "GB82 WEST 1234 5698 7654 32"), ("ssn", "123-45-6789"), ("ssn", "000-11-2222"), ("secret", 'token = "abcdef0123456789ab"'),
    ]
    assert got[2].pii == got[3].pii == got[5].pii == []
    assert [(s.start, s.stop) for s in got[4].pii] == [(7 * i, 7 * i + 6) for i in range(3000)]
    assert pii.find_pii(df.limit(0)).count() == 0
    clean = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert clean[1].startswith("é <email><email>, <ip>.5 999.1.1.1 mail: <card>; <phone>. IBAN <iban>") and clean[2] == ""


def test_pii_query_digests(spark, tmp_path):
    spark.createDataFrame([(1, "call +1 (437) 555-0689 now"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in pii.op4_pii(spark, str(tmp_path)).collect()}
    assert got[1].spans == "phone:5:22" and got[1].n_phone == 1 and got[1].base_sha256 == hashlib.sha256(b"phone:5:22").hexdigest()
    assert got[2].spans == "" and got[2].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_licenses(spark):
    body = "Some text of a file.\n" * 20
    rows = [
        ("a/LICENSE", "Released under the MIT License.", 1), ("a/x.txt", body, 1), ("a/b/c/y.txt", None, 1), ("a/b/z.txt", body + "Licensed under the Apache License, Version 2.0.", 1),
        ("a/b/c/d/COPYING", "Licensed under CC BY-NC 4.0.", 1), ("a/b/c/d/e/w.txt", "", 1), ("q/v.txt", body + "She got her licence to drive.", 1), ("q/v.txt", body, 1), (None, body, 1), ("top.txt", "All rights reserved.", 1),
    ]
    df = spark.createDataFrame(rows, "path string, text string, license int")
    got = {(r.path, r.license, r.basis, r.license_dir) for r in license_scan.scan_licenses(df).collect()}
    assert got == {
        ("a/LICENSE", "MIT", "file", "a"), ("a/x.txt", "MIT", "inherited", "a"), ("a/b/c/y.txt", "MIT", "inherited", "a"), ("a/b/z.txt", "Apache-2.0", "header", None),
        ("a/b/c/d/COPYING", "CC-BY-NC-4.0", "file", "a/b/c/d"), ("a/b/c/d/e/w.txt", "CC-BY-NC-4.0", "inherited", "a/b/c/d"), ("q/v.txt", None, "none", None),
        (None, None, "none", None), ("top.txt", "Proprietary", "header", None),
    }
    assert license_scan.scan_licenses(df.limit(0)).count() == 0 and Row


def test_headers_and_licence_files(spark):
    """Whole headers and texts, wrapped and in comments; versions, tags and copyright lines; columns of clashing names."""
    gpl = "/*\n * This program is free software; you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation; either version {} of the License, or\n * (at your option) any later version.\n */\nint x;\n" + "x = x + 1;\n" * 200
    apache = "# Copyright 2020 Some One. All rights reserved.\n#\n# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in compliance with the License.\n" + "x += 1\n" * 200
    bsd = "Copyright (c) 2020, Some One\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice.\n"
    third = "3. Neither the name of the copyright holder nor the names of its\ncontributors may be used to endorse or promote products derived from\nthis software without specific prior written permission.\n"
    isc = "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n"
    code = "\n" + "y = f(y)\n" * 100
    want = {
        "a1/x.c": (gpl.format(2), "GPL-2.0"), "a2/x.c": (gpl.format(3), "GPL-3.0"), "a3/x.c": (gpl.format(3).replace("GNU General", "GNU Lesser General"), "LGPL-3.0"),
        "a4/x.c": (gpl.format(3).replace("GNU General", "GNU Affero General"), "AGPL-3.0"), "a5/x.py": (apache, "Apache-2.0"), "a6/COPYING": (bsd, "BSD-2-Clause"),
        "a7/COPYING": (bsd + third, "BSD-3-Clause"), "a8/LICENSE": (isc, "ISC"), "a9/x.rs": ("// SPDX-License-Identifier: MIT" + code, "MIT"),
        "b1/x.rs": ("// SPDX-License-Identifier: Apache-2.0" + code, "Apache-2.0"), "b2/x.c": ("/* SPDX-License-Identifier: GPL-2.0-only */" + code, "GPL-2.0"),
        "b3/x.c": ("-- SPDX-License-Identifier: LGPL-3.0" + code, "LGPL-3.0"), "b4/x.c": ("// (c) Some One. All rights reserved." + code, "Proprietary"), "b5/x.c": (code, None),
        "c1/x.hpp": ("// Distributed under the Boost Software License, Version 1.0." + code, "BSL-1.0"), "c3/UNLICENSE": ("This is free and unencumbered software released into the public domain.\n", "Unlicense"),
        "c2/x.java": ("/*\n * Copyright (c) 2020 Some One. All rights reserved.\n * This program and the accompanying materials are made available under the\n * terms of the Eclipse Public License v1.0 which accompanies this distribution.\n */" + code, "EPL-1.0"),
        "c4/boost.txt": ("Permission is hereby granted, free of charge, to any person or organization\nobtaining a copy of the software and accompanying documentation covered by\nthis license (the \"Software\") to use, reproduce, display, distribute, execute,\nand transmit the Software, and to prepare derivative works of the Software,\nand to permit third-parties to whom the Software is furnished to do so, all\nsubject to the following:\n", "BSL-1.0"),
        "c4/d/y.c": (code, "BSL-1.0"), "c5/a.c": ("// SPDX-License-Identifier: MIT\n", "MIT"), "c5/b.c": ("int x;\n", None), "c5/q/c.c": ("int y;\n", None),
        "b6/x.txt": ("word " * 300_000 + "\nReleased under the MIT License.\n" + "Released under the Apache License, Version 2.0.\n", "MIT"),
    }
    rows = [(p, t, "u", "v", "w") for p, (t, _) in want.items()]
    df = spark.createDataFrame(rows, "path string, text string, _own string, _near string, license_dir string")
    out = license_scan.scan_licenses(df).collect()
    assert {r.path: r.license for r in out} == {p: name for p, (_, name) in want.items()} and all((r._own, r._near) == ("u", "v") for r in out)
