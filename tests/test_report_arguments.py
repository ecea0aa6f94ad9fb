"""Arguments that a report cannot do without."""

import pytest

from revtrellis.plans import reports


def test_partner_team_amer_needs_its_campaigns(monkeypatch):
    monkeypatch.setattr(reports.funnel, "lead_opportunity_funnel", lambda source, spec: spec)
    with pytest.raises(TypeError):
        reports.partner_team_amer(None)
    with pytest.raises(ValueError):
        reports.partner_team_amer(None, (), ())
    spec = reports.partner_team_amer(None, ("a campaign",), ("001",))
    assert spec.lead_campaigns == ("a campaign",) and spec.excluded_accounts == ("001",)
    assert spec.creation_role_patterns == reports.PARTNER_AMER.creation_role_patterns


def test_the_bare_settings_are_not_complete():
    with pytest.raises(ValueError, match="lead_campaigns"):
        reports.funnel.lead_opportunity_funnel(None, reports.PARTNER_AMER)
