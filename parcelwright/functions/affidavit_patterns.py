"""What lien affidavits say, as patterns. They decide which documents are read how."""

from __future__ import annotations

HEADER = r"(?m)^\s*\d{4}\s*-\s*(\d{10})\s+(\d{1,2}/\d{1,2}/\d{4})"
LIEN_ID = r"(?i)AFFIDAVIT\s+OF\s+LIEN\s+([A-Z]\d+)"
# An account number may break over lines, with stray dots between its groups.
_ACCOUNT = r"\d{4}\s*-?\s*[.\s]*\s*\d{4}\s*-?\s*[.\s]*\s*\d{4}"
ACCOUNT = rf"(?i)Account\s+No[.,]?\s+({_ACCOUNT})"
# Lot and block in either order and either spelling.
LEGAL = (
    r"(?m)^([A-Z][A-Z0-9 ]+?(?:BLK\s+\d+\s+LOT\s+\d+(?:[,\s]+\d+)*|LOT\s+\d+(?:[,\s]+\d+)*\s+BLK\s+\d+"
    r"|LT\s+\d+(?:[,\s]+\d+)*\s+BK\s+\d+|BK\s+\d+\s+LT\s+\d+(?:[,\s]+\d+)*))"
)
# The street follows the account number; up to 16 characters of it may stand on the next line.
STREET = rf"(?i)Account\s+No[.,]?\s+{_ACCOUNT}[.,]?\s+([A-Z0-9][^\n]+(?:\n[A-Z0-9][A-Z0-9 ]{{1,15}})?)\s*(?:\n|$)"
STREET_WORDS = 8
NOT_A_STREET = r"(?i)^That\s+s[ai][il]d\b|\b(was\s+completed|at\s+a\s+total\s+cost|which\s+was\s+invoiced)\b"
WORK = r"(?i)completed\s+on\s+or\s+about\s+(\d{1,2}/\d{1,2}/\d{4}).*?total\s+cost\s+of\s+\$([\d,]+\.\d{2})"
OWNER_BLOCK = r"(?is)record\s+owner.*?is:?\s*\n\s*(.+?)\n\s*\W?That\s+s[ai][il]d"
# A company's name goes on in the second line if that ends, or shortly begins, with such a word.
NAME_ENDS = (
    r"(?i)\b(LLC|L\.?L\.?C|INC|INCORPORATED|CORP|CORPORATION|LP|L\.?P|LTD|LIMITED|CO|COMPANY|TRUST|FOUNDATION|ASSOCIATION|ASSN"
    r"|PARTNERS|PARTNERSHIP|HOLDINGS|ENTERPRISES|PROPERTIES|INVESTMENTS)\b\.?\s*$"
)
NAME_GOES_ON = (
    r"(?i)^(OPERATIONS|HOLDINGS|GROUP|ENTERPRISES|PROPERTIES|INVESTMENTS|MANAGEMENT|REAL\s+ESTATE|DEVELOPMENT|VENTURES|PARTNERS|CAPITAL"
    r"|REALTY|HOMES|CONSTRUCTION|CONSTR)\b"
)
SHORT_LINE = 4
SPOUSE = r"(?i)^(.+?)\s+AND\s+(?:WF|WIFE|HUS|HUSBAND|SPOUSE)\s+(.+)$"
PLACE = r"^(.+?),\s*([A-Z]{2})\s+(\d{5})(?:-\d{4})?[.,]?\s*$"
REASON = r"(?is)removing,?\s+cleaning,?\s+clearing(.+?)matter"
CITY, STATE = "CORPUS CHRISTI", "TX"
