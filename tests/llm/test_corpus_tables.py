"""Decontamination, licences, mixing, chat, and the pipeline."""

import hashlib
import math
import random
import re
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from conftest_odd import ODD
from tierstone.llm import chat, decontamination, licences, mixing

# ---------------------------------------------------------------- decontamination


def bench(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def test_contamination_matches_brute_force(spark, make):
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice("ab") + rng.choice("cd") for _ in range(n))
    items = [(i, text(rng.randint(1, 14))) for i in range(12)] + [(50, None), (51, "  "), (None, "ac"), (3, "bd bd BD")]
    docs = [(i, rng.choice([" ", ", ", "-"]).join(text(rng.randint(0, 60)).upper().split())) for i in range(40)] + [r[:2] for r in ODD]
    docs += [(99, "x " + items[0][1] + " y"), (98, "É" + "ac")]
    got = sorted((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in decontamination.contamination(make(*docs), bench(spark, *items)).collect() if r.doc_id is not None)
    expected = [(d, *r) for (d, _), r in zip(docs, brute.contamination([t for _, t in docs], items)) if d is not None]
    assert got == sorted(expected)


def test_contamination_of_empty_tables(spark, make):
    assert decontamination.contamination(make(), bench(spark, (1, "a b"))).collect() == []
    got = decontamination.contamination(make(*ODD), bench(spark)).collect()
    assert len(got) == len(ODD) and not any(r.contaminated for r in got)
    assert decontamination.clean(make(*ODD), bench(spark, (1, "another text under the same id with"))).count() == len(ODD) - 1


def plain_near(docs, items, window, slop, share):
    """{(place in docs, window, start): words found} by trying every start."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {tuple(w[i : i + window]) for _, t in items if (w := word.findall(brute.lower(t))) for i in range(max(1, len(w) - window + 1))}
    out = {}
    for d, text in enumerate(docs):
        words = word.findall(brute.lower(text))
        for w in windows:
            for s in range(-len(w), len(words) + slop):
                near = lambda k, *run: any(0 <= p and tuple(words[p : p + len(run)]) == run for p in range(s + k - slop, s + k + slop + 1))
                if len(w) == 1:
                    hits, need, pairs, intact = int(0 <= s < len(words) and words[s] == w[0]), 1, 0, 0
                else:
                    hits, pairs = sum(near(k, t) for k, t in enumerate(w)), sum(near(k, *w[k : k + 2]) for k in range(len(w) - 1))
                    need = math.ceil(len(w) * share)
                    intact = max(1, len(w) - 1 - 2 * (len(w) - need))
                if hits >= need and pairs >= intact:
                    out[d, " ".join(w), s] = hits
    return out


@pytest.mark.parametrize("slop,share", [(1, 0.8), (0, 0.6), (2, 1.0)])
def test_proximity_matches_brute_force(spark, make, slop, share):
    """Every start is found: recall is 1, also where the rarest words are changed, left out or absent."""
    rng = random.Random(slop)
    items = [(i, " ".join(rng.choice("abcdefghij") + rng.choice("xyz") for _ in range(rng.randint(1, 13)))) for i in range(10)]
    docs = []
    for i in range(40):
        words = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(words) + 1)
            words[at : at + rng.randint(0, 1)] = rng.choice([[], ["new"], ["ax"]])
        docs.append(" ".join(["ax"] * rng.randint(0, 3) + words + [rng.choice("abc") + "y" for _ in range(rng.randint(0, 6))]))
    sought = decontamination.phrases(bench(spark, *items))
    index = decontamination.build_index(make(*enumerate(docs)), sought.terms, sought.pairs)
    ids = {r.doc: r.doc_id for r in index.select("doc", "doc_id").distinct().collect()}
    names = {r.win: r.words for r in sought.windows.join(sought.terms, "term_id").groupBy("win").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("off", "term"))), lambda x: x["term"]), " ").alias("words")).collect()}
    found = decontamination.near_occurrences(index, sought, slop, share).collect()
    assert {(ids[r.doc], names[r.win], r.start): r.n_found for r in found} == plain_near(docs, items, 10, slop, share)
    assert len(found) == len({(r.doc, r.win, r.start) for r in found})


def test_a_replaced_rarest_word_is_still_near(spark, make):
    item = "zebra quartz of the jumping vixen over a lazy dog"
    docs = make((1, item), (2, item.replace("zebra", "horse")), (3, item.replace("zebra ", "").replace("quartz", "rock")), (4, "zebra and far away of the end of things some quartz"), (5, None))
    got = {r.doc_id: (r.item_ids, r.near_items) for r in decontamination.contamination(docs, bench(spark, (1, item)), near=True).collect()}
    assert got == {1: (["1"], ["1"]), 2: ([], ["1"]), 3: ([], ["1"]), 4: ([], []), 5: ([], [])}
    alone = make((2, item.replace("zebra", "horse")))  # zebra is nowhere in the corpus
    assert decontamination.contamination(alone, bench(spark, (1, item)), near=True).first().near_items == ["1"]


def test_plans_have_no_python(spark, make):
    rows = make((1, "a b c"))
    frames = [decontamination.contamination(rows, bench(spark, (1, "a b")), near=True), mixing.mix(rows), mixing.mixed_documents(rows)]
    frames.append(licences.scan(licence_files(spark, (1, "a/b", "MIT License"))))
    for df in frames:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


# ---------------------------------------------------------------- licences


def licence_files(spark, *rows):
    return spark.createDataFrame(list(rows), "key long, path string, text string")


def test_licences_own_and_inherited(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    files = licence_files(
        spark,
        (1, "a/LICENSE", mit),
        (2, "a/b/c/code", "no notice here"),
        (3, "a/b/COPYING.txt", gpl),
        (4, "a/b/other", "words\n" * 50 + "Licensed under CC BY-NC 4.0."),
        (5, "z/file", "nothing of the kind"),
        (6, "a/x/y", None),
        (7, None, mit),
        (8, "a/x/plain", "permission to speak about copyright in general terms of unrelated prose and more"),
        (8, "a/x/plain", "permission to speak about copyright in general terms of unrelated prose and more"),
        (9, "top", ""),
    )
    got = sorted((r.key, r.licence, r.found, r.licence_dir) for r in licences.scan(files).collect())
    assert got == [
        (1, "MIT", "own", None),
        (2, "GPL-3.0", "inherited", "a/b"),
        (3, "GPL-3.0", "own", None),
        (4, "CC-BY-NC-4.0", "own", None),
        (5, None, None, None),
        (6, "MIT", "inherited", "a"),
        (7, "MIT", "own", None),
        (8, "MIT", "inherited", "a"),
        (8, "MIT", "inherited", "a"),
        (9, None, None, None),
    ]


def test_every_template_is_its_own_best(spark):
    rows = [(i, f"d{i}/file", f"Some words before.\n{text}\nand after") for i, (_, text) in enumerate(licences.TEMPLATES)]
    got = {r.key: (r.licence, r.score) for r in licences.scan(licence_files(spark, *rows)).collect()}
    for i, (name, _) in enumerate(licences.TEMPLATES):
        assert got[i] == (name, 1.0)


def test_licences_of_no_files(spark):
    assert licences.scan(licence_files(spark)).collect() == []


def test_root_licence_reaches_down(spark):
    files = licence_files(spark, (1, "LICENSE", "The MIT License (MIT)"), (2, "deep/er/file", "x"), (3, "file", "y"))
    assert {(r.key, r.licence, r.licence_dir) for r in licences.scan(files).collect()} == {(1, "MIT", None), (2, "MIT", ""), (3, "MIT", "")}


def test_notices_that_wrap_or_lie_in_a_paragraph(spark):
    prose = "some plain words of a story that goes on and says nothing of the kind for quite a while " * 3
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed\n"
    files = licence_files(
        spark,
        (1, "a/COPYING", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n" + prose),
        (2, "b/code", mpl + prose),
        (3, "c/LICENSE", "Mozilla Public License Version 2.0\n==================================\n" + prose),
        (4, "d/code", prose + "This work is licensed under the GNU General Public License, version 3. " + prose),
        (5, "e/code", "# SPDX-License-Identifier: GPL-3.0-or-later\n" + prose),
        (6, "f/code", "// SPDX-License-Identifier: (Zlib)\n" + prose),
        (7, "g/code", prose + "all rights\nreserved " + prose),
        (8, "h/code", prose + "a license to speak\nin public\n" + prose),
        (9, "i/code", "SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0"),
        (10, "a/code", prose),
    )
    got = {r.key: (r.licence, r.found) for r in licences.scan(files).collect()}
    own = {1: "GPL-3.0", 2: "MPL-2.0", 3: "MPL-2.0", 4: "GPL-3.0", 5: "GPL-3.0", 6: "Zlib", 7: "Proprietary", 9: "GPL-2.0"}
    assert got == {**{k: (v, "own") for k, v in own.items()}, 8: (None, None), 10: ("GPL-3.0", "inherited")}


def test_licence_files_are_compared_whole(spark):
    """Files as projects have them: a title or a holder's line, the text, and nothing a short prefix would show."""
    texts = dict(licences.WHOLE_TEXTS)
    holder = "Copyright (c) 2019, A. N. Author\nAll rights reserved.\n\n"
    prose = "some plain words of a story that goes on and says nothing of the kind " * 60
    files = {
        "LGPL-2.1": "                  GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 2.1, February 1999\n\n Copyright (C) 1991, 1999\n" + prose,
        "EPL-2.0": "Eclipse Public License - v 2.0\n\n    THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE\n" + prose,
        "BSL-1.0": texts["BSL-1.0"],
        "CC-BY-NC-ND-4.0": "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License\n" + prose,
        "BSD-2-Clause": "BSD 2-Clause License\n\n" + holder + texts["BSD-2-Clause"],
        "BSD-3-Clause": "BSD 3-Clause License\n\n" + holder + texts["BSD-3-Clause"],
        "MIT": "MIT License\n\n" + holder + texts["MIT"],
        "ISC": holder + texts["ISC"],
        "Zlib": holder + texts["Zlib"],
        "Artistic-2.0": "                       The Artistic License 2.0\n\n           Copyright (c) 2000-2006\n" + prose,
        "GPL-2.0": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n" + prose,
        "AGPL-3.0": "                    GNU AFFERO GENERAL PUBLIC LICENSE\n                       Version 3, 19 November 2007\n" + prose,
        "Apache-2.0": "                                 Apache License\n                           Version 2.0, January 2004\n" + prose,
    }
    rows = [(i, f"d{i}/LICENSE", text) for i, text in enumerate(files.values())] + [(100 + i, f"d{i}/src/code", "no notice") for i in range(len(files))]
    got = {r.key: (r.licence, r.found) for r in licences.scan(licence_files(spark, *rows)).collect()}
    for i, name in enumerate(files):
        assert got[i] == (name, "own") and got[100 + i] == (name, "inherited")
    # a clause late in a file tells two licences apart
    late = "x " * 60 + texts["BSD-3-Clause"]
    assert licences.scan(licence_files(spark, (1, "LICENSE", late))).first().licence == "BSD-3-Clause"


# ---------------------------------------------------------------- mixing


def words_in(text):
    return len(brute.WORD.findall(text or ""))


def filled_targets(sizes, weights=(5, 2, 1)):
    """Reshare the excess of stopped sources until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    stopped, total = {}, 1.5 * sum(sizes.values())
    while True:
        rest = total - sum(stopped.values())
        open_weight = sum(weight[s] for s in names if s not in stopped)
        above = [s for s in names if s not in stopped and rest * weight[s] / open_weight > 2 * sizes[s]] if open_weight else []
        if not above:
            return {s: stopped.get(s, rest * weight[s] / open_weight if s not in stopped else 0) for s in names}
        stopped.update({s: 2.0 * sizes[s] for s in above})


def seats(votes, n):
    """Sainte-Laguë one seat at a time."""
    got = {p: 0 for p in votes}
    for _ in range(n):
        if any(votes.values()):
            got[min(votes, key=lambda p: (-votes[p] / (2 * got[p] + 1), p))] += 1
    return got


def test_highest_quotients_match_one_seat_at_a_time(spark):
    rng = random.Random(12)
    for total in (1, 7, 100):
        votes = {f"p{i:02d}": rng.choice([0, 1, 3, 3, 10, 500, 7000]) for i in range(25)}
        df = spark.createDataFrame([(p, v, total) for p, v in votes.items()], "p string, v long, n long")
        got = {r.p: r.blocks for r in mixing.highest_quotients(df, [], ["p"], "v", "n").collect()}
        assert got == seats(votes, total)


def mixed(docs, **options):
    return mixing.mix(docs, **options).collect()


def check_mix(rows, got, slack):
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += words_in(text)
    targets, taken = filled_targets(sizes), defaultdict(int)
    for r in got:
        assert r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source])
        taken[r.source] += r.taken
    for source, target in targets.items():
        assert abs(taken[source] - target) <= slack, source


def mix_rows(seed, n):
    rng = random.Random(seed)
    return [(i, "w " * rng.choice([0, 1, 5, 40, 300, 2000]), None, rng.choice(["a", "a", "a", "b", "c", "d", None, "Z"])) for i in range(n)]


@pytest.mark.parametrize("shard_tokens", [10**9, 5000])
def test_mix_meets_targets(make, shard_tokens):
    rows = mix_rows(3, 300)
    got = mixed(make(*rows), shard_tokens=shard_tokens)
    shards = len({r.shard for r in got})
    assert sorted((r.doc_id, r.size) for r in got) == sorted((i, words_in(t)) for i, t, _, _ in rows)
    check_mix(rows, got, slack=2 * mixing.BLOCK_TOKENS * (1 + shards / 2))
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixed(make(*rows[::-1]), shard_tokens=shard_tokens)), key=repr)


def test_mix_matches_brute_force(make):
    """Blocks laid out and picked one by one."""
    rows, block, seed = mix_rows(5, 120), 32, 7
    got = {r.doc_id: r for r in mixed(make(*rows))}

    def chained(number, salt):
        first = xxhash.xxh64_intdigest(number.to_bytes(8, "little", signed=True), 42)
        value = xxhash.xxh64_intdigest(salt.to_bytes(4, "little"), first)
        return value - (1 << 64) if value >> 63 else value

    by_source = defaultdict(list)
    for i, text, _, source in rows:
        by_source[source].append((chained(i, seed + 1), i, words_in(text)))
    sizes = {s: sum(n for _, _, n in d) for s, d in by_source.items()}
    targets = filled_targets(sizes)
    quota = seats({(s is None, s or ""): t for s, t in targets.items()}, round(sum(targets.values()) / block))
    for source, docs in by_source.items():
        n_blocks = max(1, -(-sizes[source] // block))
        rounds, rest = divmod(quota[source is None, source or ""], n_blocks)
        rounds, rest = (rounds, rest) if rounds < 2 else (2, 0)
        # which blocks the permutation picks is seeded; it must pick exactly `rest` of them
        extra = {i: got[i].taken - rounds * n for _, i, n in docs}
        assert sum(extra.values()) <= rest * block
        assert sum(extra.values()) >= (rest - 1) * block if rest else sum(extra.values()) == 0
        assert all(0 <= extra[i] <= n for _, i, n in docs)
        # a document that lies within one block is taken with that block or not at all
        place = 0
        for _, i, n in sorted(docs):
            if n and place // block == (place + n - 1) // block:
                assert extra[i] in (0, n)
            place += n


def test_equal_rows_are_spread_over_shards(make):
    """Six tenths of the rows are one row without an id; no stream holds many of them."""
    rows = [(None, "w " * 40, None, "hot")] * 600 + [(i, "w " * 30, None, "abc"[i % 3]) for i in range(400)]
    got = mixed(make(*rows), shard_tokens=2_000)
    check_mix(rows, got, slack=2 * mixing.BLOCK_TOKENS * 20)
    per_shard = defaultdict(int)
    for r in got:
        per_shard[r.shard] += r.doc_id is None
    assert len(per_shard) >= 15 and max(per_shard.values()) <= 600 / len(per_shard) + 1
    few = mixed(make(*[(None, None, None, "x")] * 500, (1, "a b", None, "x")), shard_documents=50)
    assert len({r.shard for r in few}) == 11


def test_mix_does_not_depend_on_order_or_partitions(spark, make, tmp_path):
    """Rows of one id and size but different texts, and copies, get the same shares however they come."""
    rng = random.Random(9)
    rows = [(rng.randrange(4), " ".join(rng.choice("abc") for _ in range(rng.choice([3, 20, 45]))), None, rng.choice(["s", "t", None])) for _ in range(300)]
    rows += [(7, "same words over and over " * 4, None, "s")] * 90 + [(8, None, None, "s"), (9, "", None, "t")]
    seen = []
    for n, (some, parts) in enumerate(((rows, 1), (rows[::-1], 1), (rows, 7))):
        make(*some).repartition(parts).write.parquet(f"{tmp_path}/{n}")
        out = mixing.mixed_documents(spark.read.parquet(f"{tmp_path}/{n}")).collect()
        seen.append(sorted((r.doc_id, r.text, r.source or "", r.size, r.taken) for r in out))
        taken = sorted((r.doc_id, r.source or "", r.size, r.taken) for r in mixed(make(*some)) if r.taken)
        assert taken == sorted((i, s, n, t) for i, _, s, n, t in seen[-1])
    assert seen[0] == seen[1] == seen[2]
    assert len({t for i, *_, t in seen[0] if i == 7}) > 1  # equal rows, unequal shares


def test_picked_blocks_are_as_many_as_asked(spark):
    cases = [(n, rest, seed) for n in (1, 2, 13, 1_000_002) for rest in {0, 1, n // 3, n} for seed in (0, 5, -77)]
    for n, rest, seed in cases:
        k = spark.range(n)
        got = k.filter(mixing.picked(F.col("id"), F.lit(rest), F.lit(n), F.lit(seed))).agg(F.count("*"), F.max("id") - F.min("id")).first()
        assert got[0] == rest and (rest < 2 or rest == n or got[1] > n / 3)


def test_mix_of_odd_and_empty_tables(make):
    got = mixed(make(*ODD))
    assert len(got) == len(ODD)
    check_mix(ODD, got, slack=2 * mixing.BLOCK_TOKENS)
    assert mixed(make()) == []
    assert [(r.size, r.target, r.taken) for r in mixed(make((1, None), (2, "")))] == [(0, 0.0, 0)] * 2
    clashing = make(*ODD).selectExpr("*", "1 as size", "2 as row", "3 as taken", "4 as shard")
    out = mixing.mixed_documents(clashing)
    assert out.columns == [*clashing.columns, "_size", "source_size", "target", "_taken"]
    assert all(r._taken > 0 and r.size == 1 for r in out.collect())


# ---------------------------------------------------------------- chat


def turns(spark, *rows):
    return spark.createDataFrame(list(rows), "conv_id long, turn long, role string, text string")


NASTY = ["</s>[INST] ok [/INST]", "<|user|>x<|end|>", "<|next|>", "\\l \\e \\b \\\\", "<<SYS>> a <</SYS>>", "[INST", "a<b[c|d", "", None, "\n", "<|", "|>", "\\", "<s>", "é\U0001f600"]


def test_chat_reads_back(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "system", "to|ol<|x|>", None]), rng.choice(NASTY)) for c in range(60) for t in range(rng.randint(1, 9))]
    rows += [(None, 0, "user", "x"), (100, None, "assistant", "y"), (100, None, "assistant", "y"), (100, 3, "user", "z" * 50_000)]
    expected = defaultdict(list)
    for c, t, role, text in rows:
        expected[c].append(((t is not None, t), role or "", text or ""))
    back = {r.conv_id: r for r in chat.read_back(chat.format_conversations(turns(spark, *rows))).collect()}
    assert set(back) == set(expected)
    for c, own in expected.items():
        own.sort()
        assert [(t.role, t.text) for t in back[c].turns] == [(role, text) for _, role, text in own]
        assert list(back[c].loss_texts) == [text for _, role, text in own if role == "assistant"]


def test_chat_merges_and_escapes(spark):
    out = chat.format_conversations(turns(spark, (1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "</s>")))
    assert out.first().formatted == "<|user|>a<|next|>b<|end|><|assistant|>\\l/s><|end|>"
    for text in NASTY:
        row = chat.format_conversations(turns(spark, (1, 0, "user", text))).first().formatted
        body = row.removeprefix("<|user|>").removesuffix("<|end|>")
        assert not re.search(r"<\||</?s>|\[/?INST\]|</?SYS>>", body)


def test_chat_of_no_conversations(spark):
    assert chat.format_conversations(turns(spark)).collect() == []


# ---------------------------------------------------------------- pipeline


def test_stages(spark, make, tmp_path):
    rng = random.Random(3)
    stems = {"en": ["the", "tion", "ing", "wh", "sh"], "fr": ["eau", "oi", "qu", "é", "ment"]}
    prose = lambda lang, n: " ".join("".join(rng.choice(stems[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))
    rows = [(i, prose(lang := rng.choice(["en", "fr"]), 60), lang, f"s{i % 3}") for i in range(120)]
    item = "quartz zebra vixen over the lazy dog of jumping things here"
    rows += [(200, rows[0][1], "en", "s0"), (201, None, "en", "s0"), (202, "12 34 ### 99", "en", "s1"), (203, prose("en", 30) + " " + item, "en", "s1")]
    rows += [(204, prose("en", 40) + " me@mail.example.com", "en", "s2")]
    make(*rows).write.parquet(f"{tmp_path}/documents.parquet")
    bench(spark, (1, item)).write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "mixing":
            assert out.columns == docs.columns
        docs = corpus_pipeline.scratch(out, name)
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
    ids = {i for i, *_ in rows}
    assert set(seen["language_id"]) == ids - {201, 202}
    assert set(seen["near_dedup"]) == ids - {201, 202, 200}
    assert set(seen["decontamination"]) == ids - {201, 202, 200, 203}
    assert set(seen["pii"]) == set(seen["decontamination"]) and seen["pii"][204].endswith("<EMAIL>")
    assert set(seen["mixing"]) <= set(seen["pii"])
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(seen["mixing"])


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_bear_odd_and_empty_tables(spark, make, tmp_path, name, stage):
    bench(spark, (1, "a b"), (None, None)).write.parquet(f"{tmp_path}/benchmark.parquet")
    extra = make(*ODD).selectExpr("*", "1 as fp", "2 as score", "3 as lang_pred", "4 as dirty_id", "5 as doc")
    stage(spark, extra, str(tmp_path)).collect()
    assert stage(spark, make(), str(tmp_path)).collect() == []


def test_digest_of_nothing():
    assert brute.digest([]) == hashlib.sha256(b"").hexdigest()
