"""The jobs in a row, as a user would submit them."""

import json

from textpulse import storage
from textpulse.jobs import main
from textpulse.operators.star import Star
from textpulse.sources.warehouse import Warehouse
from workload import inputs


def test_from_feeds_to_reports(spark, sf_dir, tmp_path, capsys):
    root = storage.fresh_dir(spark, "test-cli")
    archive = tmp_path / "tweets.csv"
    archive.write_text(
        "a,b,c,d,e,f,g,h,date,text\n"
        + "".join(f'{i},,,,,,,,2024-01-0{i % 9 + 1} 10:00:00,"tweet {i}, about bitcoin"\n' for i in range(40))
    )
    changes = tmp_path / "changes.json"
    edit = {"server_name": "en.wikipedia.org", "type": "edit", "title": "Film", "comment": "fix, see \n film"}
    changes.write_text("\n".join(json.dumps(e) for e in (edit, {**edit, "type": "log"}, {**edit, "title": None})))
    pages = tmp_path / "pages.json"
    pages.write_text(json.dumps({"tweets": [{"text": "hello robot"}, {"full_text": "second"}, {"text": ""}]}))

    topic, log = f"{root}/topic", f"{root}/log"
    for feed, path in (("tweets", archive), ("changes", changes), ("search", pages)):
        main(["publish", "--feed", feed, "--input", str(path), "--topic-path", topic], spark)
    ingest = ["ingest", "--topic-path", topic, "--log", log, "--checkpoint", f"{root}/check", "--drain"]
    main(ingest, spark)
    model = f"{inputs.trained(spark, sf_dir)}/model"
    load = ["etl", "--log", log, "--warehouse", f"{root}/star", "--model", model]
    for _ in range(2):
        main([*load, "--run-ts", "2024-02-01 00:00:00"], spark)

    star = Star.of(Warehouse(spark, f"{root}/star"))
    assert star.facts.count() == 43
    names = {r.source_name: r["count"] for r in star.joined().groupBy("source_name").count().collect()}
    assert names == {"Twitter (Bitcoin Dataset)": 40, "Wikipedia (Filtered)": 1, "Twitter (Real)": 2}

    at = ["--warehouse", f"{root}/star"]
    capsys.readouterr()
    main(["sql", *at], spark)
    main(["values", *at], spark)
    main(["page", *at, "--grain", "Day", "--source", "Twitter (Real)"], spark)
    main(["adhoc", *at, "--keyword", "TWEET 7,", "--first-day", "2024-01-01", "--last-day", "2024-01-31"], spark)
    main(["recent", *at, "--limit", "5", "--output", f"{root}/recent"], spark)
    shown = capsys.readouterr().out
    assert "43" in shown and "Crypto" in shown and "tweet 7, about bitcoin" in shown
    assert spark.read.parquet(f"{root}/recent").count() == 5
