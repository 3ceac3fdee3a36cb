"""Report operators: cleaning, KPIs, breakdowns, trends, cohorts, insights."""
