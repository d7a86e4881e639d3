"""Click requests to outcomes and events."""

from conftest import rows

from clickmeter.plans import audits, capture
from clickmeter.schemas import AD, CLICK_REQUEST
from clickmeter.sources.catalog import catalog_findings, load_catalog, upsert_ads

AT = "2026-06-13T14:07:43Z"
HTTPS = "https://advertiser.example/landing"


def ads(spark):
    return spark.createDataFrame(
        [
            ("ad_1", "camp_1", "adv_1", HTTPS, True, AT),
            ("ad_off", "camp_1", "adv_1", HTTPS, False, AT),
            ("ad_unset", "camp_1", "adv_1", HTTPS, None, AT),
        ],
        AD,
    )


def requests(spark, *asked):
    return spark.createDataFrame(
        [
            (f"r{n}", ad, impression, click_ts, None, received or AT)
            for n, (ad, impression, click_ts, received) in enumerate(asked)
        ],
        CLICK_REQUEST,
    )


ASKED = [
    ("ad_1", "imp_1", "2026-06-13T14:06:42Z", None),
    ("ad_1", "imp_1", None, "2026-06-13T14:08:00Z"),
    ("nope", "imp_2", None, None),
    ("ad_off", "imp_2", None, None),
    ("ad_unset", "imp_2", None, None),
    ("ad_1", None, None, None),
    ("  ", "", None, None),
    (None, None, None, None),
    ("ad_1", "imp_3", "soon", None),
    (" ad_1 ", "\timp_4", None, None),
]


def test_outcomes(spark):
    found = rows(
        capture.outcomes(requests(spark, *ASKED), ads(spark)),
        "request_id",
        "status",
        "reason",
        "emitted",
        "location",
    )
    assert found == [
        ("r0", 302, None, True, HTTPS),
        ("r1", 302, None, False, HTTPS),
        ("r2", 404, "unknown_ad", False, None),
        ("r3", 404, "unknown_ad", False, None),
        ("r4", 404, "unknown_ad", False, None),
        ("r5", 400, "missing_parameter", False, None),
        ("r6", 400, "missing_parameter", False, None),
        ("r7", 400, "missing_parameter", False, None),
        ("r8", 400, "bad_timestamp", False, None),
        ("r9", 302, None, True, HTTPS),
    ]


def test_events_follow_the_click_time(spark):
    events = capture.click_events(requests(spark, *ASKED), ads(spark))
    assert rows(events, "impression_id", "ad_id", "campaign_id", "click_ts", "minute_bucket", "ingest_ts") == [
        ("imp_1", "ad_1", "camp_1", "2026-06-13T14:06:42Z", "2026-06-13T14:06:00Z", AT),
        ("imp_4", "ad_1", "camp_1", AT, "2026-06-13T14:07:00Z", AT),
    ]


def test_a_refused_click_does_not_use_up_its_impression(spark):
    asked = [("ad_1", "imp_1", "soon", None), ("ad_1", "imp_1", None, "2026-06-13T14:08:00Z")]
    events = capture.click_events(requests(spark, *asked), ads(spark))
    assert rows(events, "ingest_ts") == [("2026-06-13T14:08:00Z",)]


def test_same_results_without_broadcasts(spark):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    small = rows(capture.outcomes(requests(spark, *ASKED), ads(spark)))
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, -1)
        assert rows(capture.outcomes(requests(spark, *ASKED), ads(spark))) == small
    finally:
        spark.conf.set(setting, before)


def test_audits_find_no_loss_and_tally_outcomes(spark):
    answered = capture.outcomes(requests(spark, *ASKED), ads(spark))
    events = capture.click_events(requests(spark, *ASKED), ads(spark))
    assert rows(audits.loss_audit(answered, events)) == [(2, 2, 0, 0)]
    assert rows(audits.loss_audit(answered, events.where("impression_id = 'imp_4'"))) == [
        (2, 1, 1, 0)
    ]
    sent = answered.where("status = 302")
    assert rows(audits.unmatched_impressions(sent, events)) == []
    assert rows(audits.unmatched_impressions(sent, events.limit(0))) == [
        ("imp_1", "lost"),
        ("imp_4", "lost"),
    ]
    assert sum(row.requests for row in audits.outcome_tally(answered).collect()) == len(ASKED)


def test_rejected_clicks_are_those_without_an_active_ad(spark):
    found = capture.rejected_clicks(requests(spark, *ASKED), ads(spark))
    assert rows(found.where("ad_id is not null"), "request_id") == [
        ("r2",), ("r3",), ("r4",), ("r6",), ("r9",)
    ]


CATALOG = """{
  "advertisers": [{"advertiser_id": "adv_x", "name": "X"}],
  "campaigns": [{"campaign_id": "camp_x", "advertiser_id": "adv_x", "name": "Y"}],
  "ads": [
    {"ad_id": "ad_1", "campaign_id": "camp_x", "advertiser_id": "adv_x",
     "destination_url": "https://example.com/old", "active": true},
    {"ad_id": "ad_2", "campaign_id": "camp_x", "advertiser_id": "adv_x",
     "destination_url": "http://example.com/2", "active": true},
    {"ad_id": "ad_3", "campaign_id": "camp_x", "advertiser_id": "adv_x",
     "destination_url": "https://example.com/3", "active": false},
    {"ad_id": "ad_1", "campaign_id": "camp_x", "advertiser_id": "adv_x",
     "destination_url": "https://example.com/new", "active": true}
  ]
}"""


def test_catalog_document(spark, tmp_path):
    (tmp_path / "catalog.json").write_text(CATALOG)
    loaded = load_catalog(spark, str(tmp_path), AT)
    assert rows(loaded, "ad_id", "destination_url", "active", "created_at") == [
        ("ad_1", "https://example.com/new", True, AT),
        ("ad_2", "http://example.com/2", True, AT),
        ("ad_3", "https://example.com/3", False, AT),
    ]
    assert rows(capture.active_ads(loaded), "ad_id") == [("ad_1",), ("ad_2",)]
    assert rows(catalog_findings(loaded), "ad_id", "findings") == [
        ("ad_2", ["destination_url must be absolute https"])
    ]
    merged = upsert_ads(ads(spark), loaded)
    assert rows(merged, "ad_id", "campaign_id") == [
        ("ad_1", "camp_x"), ("ad_2", "camp_x"), ("ad_3", "camp_x"),
        ("ad_off", "camp_1"), ("ad_unset", "camp_1"),
    ]


def test_one_of_several_deliveries_is_emitted(spark):
    """Streams deliver at least once; ids may also be shared by different impressions."""
    one = requests(spark, ("ad_1", "imp_1", None, None))
    other = requests(spark, ("ad_1", "imp_2", None, "2026-06-13T14:09:00Z"))
    asked = one.unionByName(one).unionByName(other).unionByName(other)
    found = rows(capture.outcomes(asked, ads(spark)), "request_id", "impression_id", "emitted")
    assert found == [
        ("r0", "imp_1", False),
        ("r0", "imp_1", True),
        ("r0", "imp_2", False),
        ("r0", "imp_2", True),
    ]
    assert capture.click_events(asked, ads(spark)).count() == 2
