"""The seeded resolution cases: which metric a question binds to, and what must not be answered."""

import pytest

from frames import frame
from tallyward.operators.binding import BINDINGS, BOUNDARIES, Binding, bind_questions

# agent, question, expected metric, expected behaviour
CASES = [
    ("finance_agent", "What was our revenue last quarter?", "recognized_revenue", "ANSWER"),
    ("finance_agent", "What is our current ARR?", "annual_recurring_revenue", "ANSWER"),
    ("sales_agent", "What does our pipeline look like?", "pipeline_value", "ANSWER"),
    ("cs_agent", "Which customers have low health scores?", "health_score", "ANSWER"),
    ("finance_agent", "Show me revenue", "recognized_revenue", "ANSWER"),
    ("finance_agent", "What is our revenue run rate?", "annual_recurring_revenue", "ANSWER"),
    ("finance_agent", "What is our growth rate?", "recognized_revenue", "ANSWER"),
    ("finance_agent", "What is the CFO salary?", None, "REFUSE"),
    ("finance_agent", "What will revenue be next quarter?", None, "REFUSE"),
    ("finance_agent", "How does our revenue compare to Salesforce?", None, "REFUSE"),
    ("finance_agent", "What is our customer churn rate?", None, "REDIRECT"),
    ("executive_agent", "Show me revenue broken down by customer health segment", None, "MULTI_VIEW_ANSWER"),
    ("executive_agent", "Which customers with open support tickets have the highest churn risk?", None, "MULTI_VIEW_ANSWER"),
    ("executive_agent", "Is there a correlation between net retention and pipeline growth?", None, "MULTI_VIEW_ANSWER"),
    ("finance_agent", "What is our ARR?", "annual_recurring_revenue", "ANSWER"),
    ("finance_agent", "How are we doing on revenue?", "recognized_revenue", "ANSWER"),
    ("finance_agent", "What is our NPS score?", None, "REDIRECT"),
    ("finance_agent", "Revenue by cost center after the reorg", None, "ESCALATE"),
    ("finance_agent", "What is our blended WACC including the new facility?", None, "ESCALATE"),
    ("executive_agent", "How does customer health correlate with renewal rates?", None, "MULTI_VIEW_ANSWER"),
    ("executive_agent", "Which segments have growing pipeline but declining health scores?", None, "MULTI_VIEW_ANSWER"),
]


def _ask(spark, cases, confidence=0.95):
    ddl = "question_id int, agent_name string, question string, confidence double"
    return frame(spark, ddl, [(i, agent, text, confidence) for i, (agent, text) in enumerate(cases)])


@pytest.fixture(scope="module")
def answers(spark):
    got = bind_questions(_ask(spark, [c[:2] for c in CASES])).collect()
    return {r.question_id: r for r in got}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_seeded_case(answers, i):
    _, question, metric, behavior = CASES[i]
    assert answers[i].behavior == behavior, question
    if metric is not None:
        assert answers[i].resolved_metric == metric
    if behavior in ("REFUSE", "REDIRECT"):
        assert answers[i].resolved_metric is None and answers[i].boundary_type is not None


def test_low_confidence_asks_back(spark):
    got = bind_questions(_ask(spark, [("finance_agent", "Show me revenue"), ("finance_agent", "the CFO salary")], 0.79))
    assert [r.behavior for r in got.orderBy("question_id").collect()] == ["CLARIFY", "REFUSE"]


def test_phrases_match_whole_words_at_any_distance(spark):
    asks = [
        ("finance_agent", "We carry narrow warranties"),
        ("finance_agent", "x " * 50_000 + "ARR"),
        ("finance_agent", "Revenue-run/rate"),
        ("unknown_agent", "revenue"),
    ]
    got = bind_questions(_ask(spark, asks)).orderBy("question_id").collect()
    assert [r.behavior for r in got] == ["ESCALATE", "ANSWER", "ANSWER", "ESCALATE"]
    assert got[1].resolved_metric == got[2].resolved_metric == "annual_recurring_revenue"


def test_quotes_in_phrases(spark):
    rules = [Binding("a", "it's \\ odd", "m", "v")]
    got = bind_questions(_ask(spark, [("a", "nothing")]), rules, BOUNDARIES).collect()
    assert got[0].behavior == "ESCALATE" and got[0].resolved_metric is None


def test_every_rule_is_lower_case_words():
    assert all(r.phrase == r.phrase.lower().strip() for r in [*BINDINGS, *BOUNDARIES])
