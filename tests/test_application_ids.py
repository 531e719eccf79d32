"""Ids of applications with several guardians stay the same over runs."""

import datetime as dt

from registrar.functions import dictionaries as dic
from registrar.plans.transform._common import conform
from registrar.plans.transform.care import applications
from registrar.sources import inputs
from registrar.sources.specs import REGISTRY

DAY = dt.date(2020, 3, 1)


def test_application_ids_are_stable_for_two_guardians(spark):
    kind = next(k for k, v in dic.APPLICATION_TYPE.items() if isinstance(v, str))
    status = next(iter(dic.APPLICATION_STATUS))
    rows = [(1, "g-1", int(kind), int(status), "c1", DAY), (2, "g-2", int(kind), int(status), "c2", DAY)]
    ddl = REGISTRY["applications"].ddl()
    have = spark.createDataFrame(rows, "careid int, guid string, applicationtype int, status int, personid string, applicationdate date")
    staged = {
        "applications": conform(have, ddl),
        "mig_person": spark.createDataFrame([("p1", "c1"), ("p2", "c2")], "id string, legacy_ssn string"),
        "mig_fridge_child": spark.createDataFrame(
            [("p1", "h1", DAY, None), ("p1", "h2", DAY, None), ("p2", "h1", None, None), ("p2", "h3", DAY, None)],
            "child_id string, head_of_family string, start_date date, end_date date"),
    }
    def ids(idmap):
        out = applications({**inputs.empty(spark, "codes", "applicationrows", "extentmap", "unitmap", "childmindermap"), **staged, "idmap": idmap})
        return ({(r.legacy_guid, r.guardian_id): r.id for r in out["mig_application"].collect()}, out["idmap"])

    bare = spark.createDataFrame([("APPLICATION", "g-1", "old-id", dt.datetime(2020, 1, 1))],
                                 "type string, source_id string, target_id string, updated timestamp")
    one, written = ids(bare)
    assert len(one) == 3 and len(set(one.values())) == 3  # a link without a start holds no day
    assert one["g-1", "h1"] == "old-id"
    two, again = ids(spark.createDataFrame(written.collect(), written.schema))
    assert two == one
    assert sorted(r.source_id for r in again.collect()) == ["g-1", "g-1/h1", "g-1/h2", "g-2/h3"]
