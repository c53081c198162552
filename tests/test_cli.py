from pathlib import Path

import pytest

from tidemill.__main__ import main


def test_query_and_overview(spark, place, capfd):
    spark.range(3).write.parquet(place + "/t")
    main(["query", "SELECT COUNT(*) AS n, price_volatility(60000) AS p FROM t", "--table", f"t={place}/t"])
    main(["overview", "--table", f"t={place}/t"])
    out = capfd.readouterr().out
    assert "high" in out and "active" in out


def test_run(spark, place):
    Path(place, "in.csv").write_text("a\n1\n2\n")
    Path(place, "flow.yml").write_text(
        f"name: small\nsources: [{{type: file_csv, id: s, path: '{place}/in.csv', has_header: true}}]\n"
        "transforms: [{type: passthrough, id: p}]\n"
        f"sinks: [{{type: parquet_dir, id: o, path: '{place}/out'}}]\n"
    )
    main(["run", f"{place}/flow.yml"])
    assert spark.read.parquet(place + "/out/o.parquet").count() == 2


def test_a_command_is_needed():
    with pytest.raises(SystemExit):
        main([])
