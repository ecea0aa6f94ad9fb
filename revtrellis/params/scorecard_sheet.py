"""Built-in scorecard sheet, used where the caller brings none.

Points of the core groups are 100 split evenly over the metrics of the group.
"""

from __future__ import annotations

GROUP_1 = "1. Pipe Generation (out of 100)"
GROUP_2 = "2. Deal Management (out of 100)"
GROUP_3 = "3. Performance (out of 100)"
CORE_GROUPS = [GROUP_1, GROUP_2, GROUP_3]
OTHER_GROUP = "99. Reference metrics"

# Metric names per group.
METRICS = {
    GROUP_1: [
        "1a. Emails Sent", "1a. Calls Sent", "1b. Email Open Rate", "1c. Response Rate - Email", "1c. Response Rate - Call",
        "1d. Appointments booked responses", "1e. Show rate", "1f. Average meeting time (hr)", "1g. Created Opps",
        "1h. % Book Contacted", "1i. # Accounts Contacted", "1j. Pipe Coverage LTR", "1j. Pipe Coverage IPP", "1j. Pipe Coverage SA",
        "1k. Total Call interested", "1k. Call Interest Rate",
    ],
    GROUP_2: [
        "2a. Total Meetings Recorded", "2b. Talk-to-Meeting Conversion Rate", "2c. Multi vs Single Yr Deals - Open Pipe",
        "2d. # of Demos Scheduled", "2e. Follow-Up Rate", "2f. Stage Progression - Envision", "2f. Stage Progression - Solution",
        "2f. Stage Progression - Demonstrate", "2f. Stage Progression - Deal Craft", "2g. % of Pipe w/ Next steps",
        "2h. Average Age - Open Pipe", "2i. Meetings Accepted by Manager",
    ],
    GROUP_3: [
        "3a. Win Rate", "3c. Cycle Length", "3d. Unified Commerce Exposure", "3e. Partner attach",
        "3g. Multi vs Single Yr Deals - Closed Won", "3h. Contract Length", "3i. Product Mix Capital", "3j. Product Mix Payments",
        "3k. Product Mix Retail Payments", "3l. Product Mix Installments", "3m. Attainment LTR", "3m. Attainment IPP",
        "3m. Attainment SA", "3n. Pacing IPP", "3n. Pacing LTR", "3n. Pacing SA",
    ],
    OTHER_GROUP: [
        "1l. LQ Pipe Coverage LTR", "1l. LQ Pipe Coverage IPP", "99b. Created LTR", "99b. Created IPP",
        "99e. Targets - Actuals IPP", "99e. Targets - Actuals LTR", "99f. Total Meetings", "99h. 25Q1 Attainment LTR",
        "99h. 25Q1 Attainment IPP", "99h. 25Q1 Attainment SAU", "99i. IPP Targets", "99i. LTR Targets",
        "99k. Open Pipe LTR", "99k. Open Pipe IPP",
    ],
}

TEAM_GROUPS = [
    "D2C MM Acquisition", "D2C LA Acquisition", "D2C SMB Acquisition", "D2C MM Acceleration", "D2C SMB Acceleration",
    "D2C LA Acceleration", "ENT Emerging", "ENT Established", "Global Accounts", "Retail MM Acquisition", "Retail LA Acquisition",
    "Retail SMB Acquisition", "Retail MM Acceleration", "Retail SMB Acceleration", "Retail LA Acceleration",
    "Lending Acceleration", "Ads",
]


def rows() -> list[tuple]:
    """(team_group, system, metric, points, unit, metric_group, metric_subgroup)."""
    out = []
    for group, metrics in METRICS.items():
        for metric in metrics:
            subgroup = metric.split(".")[0] + ". " + group.split(". ")[1].split(" (")[0]
            unit = "ratio" if ("Rate" in metric or "%" in metric or "Mix" in metric) else "count"
            if group == OTHER_GROUP:
                out.append((None, "Reports", metric, 0.0, unit, group, subgroup))
            else:
                points = float(round(100 / len(metrics)))
                out += [(team, "Reports", metric, points, unit, group, subgroup) for team in TEAM_GROUPS]
    return out
