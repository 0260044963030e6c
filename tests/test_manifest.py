"""Scans of folders: only what changed is read, and rows are those of the readers."""

import os
import shutil

import pytest

from pollwright.constants import PROMPT_COLUMNS
from pollwright.sources import documents, manifest, qa_items, results
from tests.test_files import row, write, write_csv


def seen(df):
    return sorted(map(str, df.collect()))


def batches(store, part):
    return sorted(p.name for p in (store / part).glob("batch=*"))


def test_listing_reaches_every_level_and_no_hidden_file(spark, tmp_path):
    names = ["a/b/x 1+2.md", "a/b/ü%20.md", "a/c/y.md", "a/c/y.txt", "a/c/_gone.md", "a/.d/z.md", "a/b/deep/z.md", "top.md"]
    for name in names:
        write(tmp_path / name, name)
    got = manifest.list_files(spark, str(tmp_path), 2, r".*\.md").collect()
    expected = {str(tmp_path / n) for n in names[:3]}
    assert {r["path"] for r in got} == expected
    assert all(r["length"] == os.path.getsize(r["path"]) and r["modified"] == os.stat(r["path"]).st_mtime_ns // 1000 for r in got)
    assert manifest.list_files(spark, str(tmp_path / "missing"), 1).count() == 0


def test_documents_are_read_again_only_where_they_changed(spark, tmp_path):
    root, store = tmp_path / "in", tmp_path / "store"
    for case in range(6):
        write(root / "d s" / "t" / "md" / f"case_{case}.md", f"text\r\n{case}")
    write(root / "d s" / "t" / "md" / "other.ttl", "no document")
    assert manifest.scan_documents(spark, str(root), str(store)) == 7
    assert seen(manifest.scanned(spark, str(store)).drop("path")) == seen(documents.read_documents(spark, str(root)))
    assert manifest.scan_documents(spark, str(root), str(store)) == 0
    assert batches(store, "rows") == batches(store, "files") == ["batch=0"]

    write(root / "d s" / "t" / "md" / "case_1.md", "other text")
    os.utime(root / "d s" / "t" / "md" / "case_2.md", (1, 1))
    (root / "d s" / "t" / "md" / "case_3.md").unlink()
    write(root / "e" / "t" / "txt" / "case_1.txt", "new")
    assert manifest.scan_documents(spark, str(root), str(store)) == 4
    assert seen(manifest.scanned(spark, str(store)).drop("path")) == seen(documents.read_documents(spark, str(root)))
    assert spark.read.parquet(str(store / "rows" / "batch=1")).count() == 3

    # what was gone comes back, with its old time and length
    write(root / "d s" / "t" / "md" / "case_3.md", "text\r\n3")
    assert manifest.scan_documents(spark, str(root), str(store)) == 1
    assert seen(manifest.scanned(spark, str(store)).drop("path")) == seen(documents.read_documents(spark, str(root)))
    shutil.rmtree(root)
    assert manifest.scan_documents(spark, str(root), str(store)) == 8
    assert manifest.scanned(spark, str(store)).count() == 0


def test_an_empty_file_is_an_empty_text(spark, tmp_path):
    write(tmp_path / "in" / "d" / "t" / "md" / "case_1.md", "")
    assert manifest.scan_documents(spark, str(tmp_path / "in"), str(tmp_path / "store")) == 1
    assert [r["content"] for r in manifest.scanned(spark, str(tmp_path / "store")).collect()] == [""]


def test_a_lost_scan_leaves_no_trace(spark, tmp_path):
    root, store = tmp_path / "in", tmp_path / "store"
    write(root / "d" / "t" / "md" / "case_1.md", "one")
    assert manifest.scan_documents(spark, str(root), str(store)) == 1
    write(root / "d" / "t" / "md" / "case_2.md", "two")

    def lost(files):
        documents.of_files(files, "path").write.parquet(f"{store}/rows/batch=1")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        manifest.scan(spark, str(root), str(store), 3, lost)
    shutil.copytree(store / "files" / "batch=0", store / "files" / "batch=1", ignore=shutil.ignore_patterns("_SUCCESS"))
    assert manifest.scanned(spark, str(store)).count() == 1
    assert manifest.scan_documents(spark, str(root), str(store)) == 1
    assert {r["content"] for r in manifest.scanned(spark, str(store)).collect()} == {"one", "two"}
    with pytest.raises(ValueError):
        manifest.scanned(spark, str(tmp_path / "none"))


def test_items_results_catalogue_and_models(spark, tmp_path):
    items, answers = tmp_path / "items", tmp_path / "answers"
    write(items / "d" / "d_a_task_qa_pairs.json", '[{"case_id": "case_1", "n": 2.0}, {"case_id": "case_2"}]')
    write(items / "d" / "notes.json", "[]")
    assert manifest.scan_items(spark, str(items), str(tmp_path / "s1")) == 1
    assert seen(manifest.scanned(spark, str(tmp_path / "s1")).drop("path")) == seen(qa_items.read_items(spark, str(items)))
    assert seen(manifest.catalogue(spark, str(tmp_path / "s1"))) == seen(documents.catalogue(spark, str(items)))

    for model in ("m 2", "m1"):
        good = [row("case_1", Response=f"of {model}\nline two"), row("case_2")]
        write_csv(answers / model / "d" / "t" / "t_md_converted_prompts.csv", PROMPT_COLUMNS, good)
        write(answers / model / "d" / "t" / "t_ttl_converted_prompts.csv", "broken")
    assert manifest.scan_results(spark, str(answers), str(tmp_path / "s2")) == 4
    got = manifest.scanned(spark, str(tmp_path / "s2")).drop("path")
    for model in ("m 2", "m1"):
        assert seen(got.filter(got.model == model).drop("model")) == seen(results.read_results(spark, str(answers / model)))
    assert seen(manifest.models(spark, str(answers), str(tmp_path / "s2"))) == seen(results.available_models(spark, str(answers)))
