import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from feedloom.session import get_session, shared_dir
    s = get_session("local[4]", shuffle_partitions=8)
    shared_dir(s)   # the session's checkpoint dir, or a private one when unset
    yield s


def tweet_json(tid, uid, created_at, text="hello", lang="en", tags=(), name="A", screen="a"):
    import json
    return json.dumps({"id_str": str(tid), "created_at": created_at, "lang": lang, "text": text,
                       "user": {"id_str": str(uid), "name": name, "screen_name": screen},
                       "entities": {"hashtags": [{"text": t} for t in tags]}})


def raw_df(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")
