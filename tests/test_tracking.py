from datetime import date

from helpers import b2c_packages, events, packages, rows, users

from meterglass.plans import deck, reports, summary, tracking

BOUNDS = {"start_date": date(2024, 1, 1), "as_of": date(2024, 1, 31)}


def b2c(spark, *event_rows, banned=()):
    return tracking.user_tracking_b2c(events(spark, *event_rows), b2c_packages(spark), users(spark, *banned), **BOUNDS)


def test_conversion_needs_the_trial_first(spark):
    found = rows(b2c(spark,
                     ("a", "02 10:00", "u", "Subscribe", "s", "12", 5), ("b", "03 10:00", "u", "Subscribe", "t", "1", 5),
                     ("c", "04 10:00", "u", "Subscribe", "v", "2", 5),
                     ("d", "02 10:00", "w", "Subscribe", "s", "1", 5), ("e", "03 10:00", "w", "Subscribe", "t", "12", 5),
                     ("g", "05 10:00", "x", "Subscribe", "t", "1", 5), ("f", "05 10:00", "x", "Subscribe", "s", "12", 5)),
                 "userId", "date_id", "trial_conversion_cnt")
    assert [r for r in found if r[2]] == [("u", date(2024, 1, 3), 1), ("x", date(2024, 1, 5), 1)]


def test_free_trial_tokens_need_the_highest_package(spark):
    # Names sort 'Free Trial' < 'Standard': package_1 is the trial and 12 is the user's highest id.
    found = rows(b2c(spark,
                     ("a", "02 10:00", "u", "Token Used", "s", "12", -5, "1.25"),
                     ("b", "02 11:00", "u", "Token Used", "s", "2", -7, "1"),
                     ("c", "02 12:00", "u", "Token Used (Unsettled)", "s", "12", -100, "9"),
                     ("c2", "03 12:00", "u", "MainExpired", "s", "2", -1, "9"),
                     ("b", "02 11:00", "u", "Token Used", "s", "2", -7, "1")),
                 "date_id", "token_used", "free_trial_token_used", "packageName", "package_1", "package_2", "event_row",
                 "current_package_flag")
    assert found == [
        (date(2024, 1, 2), 12, 5, "Standard", "Free Trial", "Standard", 1, 0),
        (date(2024, 1, 3), None, None, "Standard", "Free Trial", "Standard", 2, 1)]


def test_bans_and_missing_users(spark):
    found = rows(b2c(spark, ("a", "02 10:00", "bad", "Token Used", "s", "1", -1), ("b", "02 10:00", None, "Token Used", "s", "1", -1),
                     ("c", "02 10:00", "odd", "Token Used", "s", "1", -1), banned=[("bad", True), ("odd", None)]), "userId")
    assert found == [("odd",)]


def test_company_bins_and_names(spark):
    sizes = {"c10": 10, "c11": 11, "c20": 20, "c21": 21}
    people = [(f"{c}-{n}", f"t-{c}", "T") for c, n_users in sizes.items() for n in range(n_users)]
    members = summary.company_members(
        spark.createDataFrame(people + people[:1] + [("lost", None, None)], "userId string, teamId string, teamName string"),
        spark.createDataFrame([(f"t-{c}", c) for c in sizes], "teamId string, companyId string"),
        spark.createDataFrame([(c, c) for c in sizes], "companyId string, companyName string"))
    assert rows(tracking.company_sizes(members)) == [
        ("c10", 1, "(1-10)"), ("c11", 2, "(11-20)"), ("c20", 2, "(11-20)"), ("c21", 3, "(21-30)")]


def b2b(spark, master, *event_rows):
    return tracking.user_tracking_b2b(
        events(spark, *event_rows), packages(spark, *master),
        spark.createDataFrame([("u", "t", "T"), ("w", "t", "T"), ("lost", None, None)],
                              "userId string, teamId string, teamName string"),
        spark.createDataFrame([("t", "c")], "teamId string, companyId string"),
        spark.createDataFrame([("c", "C")], "companyId string, companyName string"), **BOUNDS)


def test_shared_names_fan_out_and_company_days(spark):
    master = ((8, "Biz Pro", 1), (13, "Biz Pro", 2), (4, "Biz Starter", 3), (97, "Inner", 0))
    found = rows(b2b(spark, master,
                     ("a", "02 10:00", "u", "Token Used", "s", "8", -3), ("b", "04 10:00", "w", "Token Used", "s", "4", -4),
                     ("c", "03 10:00", "lost", "Token Used", "s", "4", -4), ("d", "05 10:00", "u", "Token Used", "s", "97", -4)),
                 "userId", "date_id", "packageId", "event_row", "company_first_event_row", "team_first_event_row",
                 "number_of_user_bin")
    assert found == [("u", date(2024, 1, 2), 13, 1, 1, 1, 1), ("u", date(2024, 1, 2), 8, 1, 1, 1, 1),
                     ("w", date(2024, 1, 4), 4, 1, 2, 2, 1)]


def test_total_fills_text_only(spark):
    total = tracking.user_tracking_total(
        b2c(spark, ("a", "02 10:00", "u", "Token Used", "s", "1", -1)),
        b2b(spark, ((8, "Biz Pro", 1),), ("b", "02 10:00", "u", "Token Used", "s", "8", -1)))
    found = {r.version: r for r in total.collect()}
    assert total.columns == list(tracking.TOTAL_COLUMNS)
    assert (found["B2C"].teamId, found["B2C"].company_first_event_row, found["B2C"].package_2) == ("null", None, "null")
    assert (found["B2B"].trial_conversion_cnt, found["B2B"].companyId) == (None, "c")
    assert tracking.numeric_keys(total).first().month_id == 202401


def summary_args(spark, b2c_rows, b2b_rows, b2b_master=((4, "Biz Starter", 300),), banned=()):
    return (events(spark, *b2c_rows), events(spark, *b2b_rows), b2c_packages(spark), packages(spark, *b2b_master),
            users(spark, *banned),
            spark.createDataFrame([("m", "t", "T"), ("n", None, None)], "userId string, teamId string, teamName string"),
            spark.createDataFrame([("t", "c")], "teamId string, companyId string"),
            spark.createDataFrame([("c", "C")], "companyId string, companyName string"))


def test_subscriptions_count_once_and_bans_do_not_win(spark):
    args = summary_args(spark, [
        ("a", "02 10:00", "bad", "Subscribe", "s", "1", 5), ("b", "03 10:00", "u", "Subscribe", "s", "1", 5),
        ("c", "04 10:00", "u", "Subscribe", "s", "1", 5), ("d", "03 10:00", "u", "Subscribe", None, "12", 5),
        ("e", "04 10:00", "u", "Subscribe", None, "2", 5), ("f", "04 11:00", "u", None, "s", "2", 5)], [],
        banned=[("bad", True)])
    found = rows(summary.summary_daily(*args), "date_id", "packageId", "new_paid_subscriptions",
                 "new_trial_subscriptions", "revenue_thb_est")
    assert [(str(d), p, n, t, float(r)) for d, p, n, t, r in found] == [
        ("2024-01-03", 1, 1, 0, 259.0), ("2024-01-03", 12, 0, 1, 0.0)]


def test_unlisted_package_has_no_revenue(spark):
    args = summary_args(spark, [], [
        ("a", "02 10:00", "m", "Subscribe", "s", "55", 5), ("b", "03 10:00", "n", "Subscribe", "t", "55", 5),
        ("c", "03 11:00", "n", "Token Used", "t", "55", -2, "1.5"), ("d", "03 11:00", "n", "Token Used", "t", "97", -2)])
    found = rows(summary.summary_daily(*args), "date_id", "has_company_mapping", "packageName", "revenue_thb_est",
                 "daily_active_users")
    assert [(str(d), m, n, r, u) for d, m, n, r, u in found] == [
        ("2024-01-02", True, None, None, 0), ("2024-01-03", False, None, 0, 1)]


def test_repeated_package_numbers_multiply(spark):
    use = [("a", "02 10:00", "m", "Token Used", "s", "4", -2, "1.5"), ("b", "02 11:00", "m", "Subscribe", "s", "4", 9)]
    args = summary_args(spark, [], use, ((4, "Biz Starter", 300), (4, "Biz Starter", 300)))
    row = summary.summary_daily(*args).first()
    assert (row.daily_active_users, row.usage_events, row.new_subscriptions, float(row.revenue_thb_est)) == (1, 2, 2, 600.0)
    fact = summary.summary_fact(*args)
    assert fact.where("eventType = 'Token Used'").count() == 2
    model = summary.summary_model_daily(*args).first()
    assert (model.daily_active_users, model.usage_events, float(model.serving_cost_thb)) == (1, 2, 3.0)


def test_conversion_order_is_not_checked_on_slides(spark):
    frame = events(spark, ("a", "02 10:00", "u", "Subscribe", "s", "1", 5), ("b", "03 10:00", "u", "Subscribe", "t", "12", 5),
                   ("c", "04 10:00", "w", "Subscribe", "v", "12", 5), ("d", "04 10:00", "w", "Subscribe", "x", "2", 5))
    subs = deck.subscriptions(frame, frame.limit(0), users(spark))
    listed = deck.all_packages(b2c_packages(spark), packages(spark, (4, "Biz Starter", 300)))
    assert rows(deck.conversion_packages(subs, listed)) == [("u", "Starter"), ("w", "Free Trial"), ("w", "Standard")]


def test_placeholders(spark):
    metrics = spark.createDataFrame(
        [("total_users", "41,002", "3 May 2025", 1), ("b2c_users", "18", "3 May 2025", 2),
         ("b2b_users", None, "3 May 2025", 3), ("", "9", None, 4)],
        "metric_key string, value_display string, period_display string, sort_order bigint")
    assert rows(deck.slide_placeholders(metrics)) == [
        ("{{b2c_users}}", "18"), ("{{period}}", "3 May 2025"), ("{{total_users}}", "41,002")]
    assert deck.slide_placeholders(metrics.limit(0)).count() == 0


def test_metric_children_add_up(spark, sf_dir):
    from meterglass.registry import QUERIES
    value = {r.metric_key: r.value_num for r in QUERIES["slide_metrics"](spark, sf_dir).collect()}
    assert value["total_users"] == value["b2c_users"] + value["b2b_users"]
    assert value["b2c_users"] == value["b2c_subscriber"] + value["b2c_free_trial"]
    assert value["b2b_users"] == value["b2b_subscriber"] + value["b2b_others"]


def test_tiles_without_a_previous_period(spark):
    daily = spark.createDataFrame([(date(2024, 1, 5), 100, 40, 1, 2, 0, 5)], (
        "date_id date, revenue_thb_est int, serving_cost_thb int, new_paid_subscriptions bigint, "
        "new_trial_subscriptions bigint, expirations bigint, tokens_used bigint"))
    seen = spark.createDataFrame([("u", date(2024, 1, 5))], "userId string, date_id date")
    tiles = {r.tile: r for r in reports.tiles(reports.kpi(daily, seen)).collect()}
    assert (tiles[1].value, tiles[1].change_pct, tiles[1].direction) == (100.0, 0.0, "—")
    assert (tiles[3].value, tiles[3].margin_pct, tiles[3].prev_margin_pct) == (60.0, 60.0, 0.0)
    assert tiles[4].value == 1.0
