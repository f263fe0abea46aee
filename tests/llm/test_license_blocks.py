"""Operator 5: licences in wrapped headers, comments, paragraphs and whole licence files."""
import textwrap

from peerscope.llm import licenses

STATEMENTS = {
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
}


def test_licenses_of_blocks_and_files(spark):
    rows, want = [], {}

    def add(text, license):
        want[f"{len(rows)}/x.txt"] = license
        rows.append((f"{len(rows)}/x.txt", text))

    for name, s in STATEMENTS.items():
        for width in (60, 64, 68, 72, 79):
            for mark in ("", "# ", " * ", "// "):
                add("a first line\n" + "\n".join(mark + x for x in textwrap.wrap(s, width)) + "\nx = 1\n", name)
        add("morning river " * 30 + s + " garden table" * 30, name)
    add("our notes say: Released under the MIT License. All the other words of this long line are about the sea and a garden", "MIT")
    for name, text in licenses.license_texts():
        add(text, name)
        add("\n".join("// " + x for x in text.split("\n")) + "\n", name)
    add("// SPDX-License-Identifier: GPL-3.0-or-later\nint x;", "GPL-3.0")
    add("# SPDX-License-Identifier: (MIT OR Apache-2.0)", "Apache-2.0")
    add("# SPDX-License-Identifier: unheard-of", None)
    add("the general public can see the work of the software foundation\nand a permission to copy the garden", None)
    for i in range(100):
        add(f"the work of this version is under the sea and in the terms of any {i}", None)
    df = spark.createDataFrame(rows, "path string, text string")
    got = {r["path"]: r["own"] and r["own"]["license"] for r in licenses.own_licenses(df).collect()}
    assert got == want


def test_headers_speak_for_their_file_and_licence_files_for_their_directory(spark):
    mit = "Released under the MIT License."
    whole = dict(licenses.license_texts())
    rows = [("LICENSE", STATEMENTS["GPL-3.0"]), ("src/a/util.py", f"# {mit}"), ("src/a/other.py", "plain"), ("src/a/b/deep.py", "plain"),
            ("lib/terms.txt", whole["Apache-2.0"]), ("lib/x/y.c", "plain"), ("lib/z/COPYING.md", mit), ("lib/z/q/w.c", ""),
            ("lib/z/q/v.c", STATEMENTS["BSD-3-Clause"]), ("LICENSE-notes/x.c", None), ("lib/license.c.d/u.c", "plain")]
    rows += [(f"n/{i}", "the garden of the sea is under the river") for i in range(40)]
    df = spark.createDataFrame(rows, "path string, text string")
    got = {r["path"]: (r["license"], r["license_path"]) for r in licenses.inherited(licenses.own_licenses(df)).collect()}
    own = {"LICENSE": "GPL-3.0", "src/a/util.py": "MIT", "lib/terms.txt": "Apache-2.0", "lib/z/COPYING.md": "MIT", "lib/z/q/v.c": "BSD-3-Clause"}
    speakers = {"": "LICENSE", "lib": "lib/terms.txt", "lib/z": "lib/z/COPYING.md"}

    def brute(path):
        if path in own:
            return own[path], path
        at = path
        while at:
            at = at.rpartition("/")[0]
            if at in speakers:
                return own[speakers[at]], speakers[at]

    assert got == {path: brute(path) for path, _ in rows}
