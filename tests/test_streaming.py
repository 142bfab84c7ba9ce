"""Ready files arriving as a stream."""

import snapshots as X

from tidegate import schemas as S
from tidegate.plans.runs import Warehouse, read_control
from tidegate.streaming import load_on_arrival


def statuses(spark, w):
    return {
        (r.process_name, r.business_date): (r.status, r.reason_code) for r in read_control(spark, w).collect()
    }


def test_arrivals_load_their_dates(spark, tmp_path):
    day, inbound = X.APR[10], tmp_path / "in"
    inbound.mkdir()
    w = Warehouse(str(inbound), str(tmp_path / "t"), str(tmp_path / "o"))

    def run():
        load_on_arrival(spark, w, str(tmp_path / "state"), availableNow=True).awaitTermination()

    # Transfers come first: their load fails for want of clients.
    X.put(inbound, S.TRANSFERS, day, [X.transfer(day, 1, 9101)], ok=1)
    X.put(inbound, S.CLIENTS, day, [X.client(day, 9101)])
    run()
    assert statuses(spark, w) == {(S.LOAD_TRANSFERS, day): ("FAILED", "MISSING_CLIENT_SNAPSHOT")}
    # The clients' ready file loads them and the waiting transfers.
    X.put(inbound, S.CLIENTS, day, ok=1)
    run()
    assert statuses(spark, w) == {
        (S.LOAD_CLIENTS, day): ("DONE", "LOAD_DONE"), (S.LOAD_TRANSFERS, day): ("DONE", "LOAD_DONE"),
    }
