import pytest

from strata.sources.files import bad_counts, read_sales_checked, read_scoring_set, read_scoring_set_checked

HEADER = "date,region,country,customer_id,delivery_type,revenue,cost,duration,cost_type"
GOOD = ["2019-01-02,EU,FR,7,fast,10.5,3,60,expert", "2019-01-02 10:30:00,EU,DE,8,slow,1,2,30,normal", ",,,,,,,,"]


def sales(tmp_path, *more, header=HEADER):
    path = tmp_path / "sales.csv"
    path.write_text("\n".join([header, *GOOD[:2], *more]) + "\n")
    return str(path)


def test_bad_rows_go_aside(spark, tmp_path):
    path = sales(tmp_path, "02.01.2019,EU,FR,7,fast,10.5,3,60,expert", "2019-01-02,EU,FR", "2019-01-02,EU,FR,x7,fast,ten,3,60,expert",
                 ",EU,FR,7,fast,10.5,3,60,expert", "2019-01-02,EU,FR,7,fast,1,2,60,expert,one,more", '2019-01-03,"a, b",,,,,,,')
    rows, bad = read_sales_checked(spark, path)
    got = rows.collect()
    assert [(r["customer_id"], r["revenue"], r["region"]) for r in got] == [(7, 10.5, "EU"), (8, 1.0, "EU"), (None, None, "a, b")]
    assert got[1]["date"].hour == 10 and got[0]["duration"] == "60"
    found = {r["line"]: r["reason"] for r in bad.collect()}
    assert found["02.01.2019,EU,FR,7,fast,10.5,3,60,expert"] == "date is no timestamp_ntz"
    assert found["2019-01-02,EU,FR"] == "not 9 fields"
    assert found["2019-01-02,EU,FR,x7,fast,ten,3,60,expert"] == "customer_id is no bigint; revenue is no double"
    assert found["2019-01-02,EU,FR,7,fast,1,2,60,expert,one,more"] == "not 9 fields"
    assert sorted(found.values())[0] == "customer_id is no bigint; revenue is no double" and "date is missing" in found.values() and len(found) == 5
    assert {r["reason"]: r["n"] for r in bad_counts(bad).collect()} == {"date is no timestamp_ntz": 1, "not 9 fields": 2, "customer_id is no bigint": 1,
                                                                       "revenue is no double": 1, "date is missing": 1}
    assert bad.first()["file"].endswith("sales.csv")
    assert rows.count() == 3 and bad.count() == 5  # whichever columns are read


def test_headers(spark, tmp_path):
    turned = "cost_type,duration,cost,revenue,delivery_type,customer_id,country,region,date,more"
    path = tmp_path / "turned.csv"
    path.write_text(turned + "\nexpert,60,3,10.5,fast,7,FR,EU,2019-01-02,x\n")
    rows, bad = read_sales_checked(spark, str(path))
    assert rows.first()["revenue"] == 10.5 and bad.count() == 0
    path.write_text("date,region\n2019-01-02,EU\n")
    with pytest.raises(ValueError, match="no column country"):
        read_sales_checked(spark, str(path))


def test_scoring_set(spark, tmp_path):
    path = tmp_path / "test.csv"
    path.write_text('PassengerId,Pclass,Name,Sex,Age,SibSp,Parch,Ticket,Fare,Cabin,Embarked\n892,3,"Kelly, Mr. James",male,34.5,0,0,330911,7.8292,,Q\n')
    rows, bad = read_scoring_set_checked(spark, str(path))
    assert rows.collect() == read_scoring_set(spark, str(path)).collect() and bad.count() == 0
    with path.open("a") as file:
        file.write('893,three,"Wilkes, Mrs.",female,47,1,0,363272,7,,S\n,3,"No id",male,,0,0,,,,\n')
    rows, bad = read_scoring_set_checked(spark, str(path))
    assert rows.count() == 1 and sorted(r["reason"] for r in bad.collect()) == ["PassengerId is missing", "Pclass is no int"]
