"""One rendered notice for each pattern of foreclosure notices, with what it must give.

{p} is a person, {q} another, {e} an entity's name, {n} a number of ten digits, {d} a day of two digits, {h} a
house number; none of them repeats over a table's rows for long.
"""

from __future__ import annotations

#: (field, place of the pattern in its list, notice, value).
CASES: tuple[tuple[str, int, str, str], ...] = (
    ("owner", 0, 'executed by {p}, ("Mortgagor")', "{p}"),
    ("owner", 1, "an agreement with {p}, AN UNMARRIED MAN as Grantor", "{p}"),
    ("owner", 2, 'on June 1, 2019, {e} LLC ("Borrower")', "{e} LLC"),
    ("owner", 3, "indebtedness of {q} to {q} AND {p} JR. Sample Capital", "{q} AND {p} JR"),
    ("owner", 4, "on or about {p} June 1, 2019 (Borrower", "{p}"),
    ("owner", 5, "Grantor(s)/Mortgagor(s):\n01/{d}/2019 {p}, A SINGLE MAN", "{p}"),
    ("owner", 6, "executed by {p}, whose address is 1 OAK", "{p}"),
    ("owner", 7, "executed by {p} in favor of X", "{p}"),
    ("owner", 8, "{p} (Borrower)", "{p}"),
    ("owner", 9, 'purposes, {p} (hereinafter called the "Mortgagor', "{p}"),
    ("owner", 10, "Grantor: {e} LLC\n", "{e} LLC"),
    ("owner", 11, 'Deed conveying title into {p} ("Obligor")', "{p}"),
    ("owner", 12, "a deed conveying the property described below to {p};", "{p}"),
    ("owner", 13, "WHEREAS, {p}, Trustee of DOE TRUST, 2", "{p}"),
    ("owner", 14, "WHEREAS, on June 1, 2019, {p}, A SINGLE WOMAN", "{p}"),
    ("owner", 15, "WHEREAS, {p}, executed and delivered to X", "{p}"),
    ("owner", 16, "{p} conveyed to X", "{p}"),
    ("owner", 17, "2. {p}, as Grantor(s)", "{p}"),
    ("owner", 19, "executed by {p}, {q}, provides", "{p}, {q}"),
    ("owner", 20, "Original Mortgagor/Grantor: {p} Original Beneficiary", "{p}"),
    ("owner", 21, "Grantor(s); {p}\nOriginal Trustee", "{p}"),
    ("owner", 22, "Grantor: {p}", "{p}"),
    ("owner", 23, "  01/{d}/2019 {p}, UNMARRIED", "{p}"),
    ("owner", 24, "mortgagor: {p}, of X", "{p}"),
    ("owner", 25, "obligor(s): {p} in favor of X", "{p}"),
    ("owner", 26, "debtors: {p} dated X", "{p}"),
    ("owner", 27, "record owner: {p}, of X", "{p}"),
    ("owner", 28, "No. 12 {p}, an unmarried man, executed a Deed", "{p}"),
    ("owner", 29, "executed by {e} LLC, a Texas limited", "{e} LLC"),
    ("lender", 0, 'WHEREAS, {e} Association, Inc. (the "Association")', "{e} Association, Inc"),
    ("lender", 1, 'The {e} Council of Co-Owners, Inc. (the "Council")', "{e} Council of Co-Owners, Inc"),
    ("lender", 2, "in favor of {e} Council of Co-Owners", "{e} Council of Co-Owners"),
    ("lender", 3, "WHEREAS, {e} LLC, a Texas limited liability company", "{e} LLC, a Texas limited liability company"),
    ("lender", 4, "\n Lender: {e}\n", "{e}"),
    ("lender", 5, "for the benefit of {e} ('Lender')", "{e}"),
    ("lender", 6, '{e} (hereinafter called "Beneficiary', "{e}"),
    ("lender", 7, "Because of that default, {e}, the owner and holder of the Note", "{e}"),
    ("lender", 8, "Current Beneficiary/Mortgagee: MORTGAGE ELECTRONIC REGISTRATION SYSTEMS, INC. {e}\n", "{e}"),
    ("lender", 9, "Current Mortgagee: {e} Mortgage Servicer", "{e}"),
    ("lender", 10, "The Mortgagee: {e}\n", "{e}"),
    ("lender", 11, "The Lender: {e} hereby", "{e}"),
    ("lender", 12, "{e} is the present owner", "{e}"),
    ("lender", 13, "for the benefit of the {e} BANK", "{e} BANK"),
    ("lender", 14, "1. {e} is the current mortgagee", "{e}"),
    ("lender", 15, "Beneficiary: {e} Trustee", "{e}"),
    ("lender", 16, "nominee for {e} FUNDING, its successors", "{e} FUNDING"),
    ("lender", 17, "in favor of {e}, whose address", "{e}"),
    ("loan_amount", 0, "original principal balance: ${h},5{d}.25", "{h}5{d}.25"),
    ("loan_amount", 1, "original principal:${h},5{d}", "{h}5{d}.0"),
    ("loan_amount", 2, "principal sum of $ {h},5{d}", "{h}5{d}.0"),
    ("loan_amount", 3, "in the original amount of ${h},5{d}.00", "{h}5{d}.0"),
    ("loan_amount", 4, "Note: payable ( ${h},5{d} )", "{h}5{d}.0"),
    ("loan_amount", 5, "Amount: ${h},5{d}.10", "{h}5{d}.1"),
    ("loan_amount", 7, "the note is for ${h},5{d}", "{h}5{d}.0"),
    ("deed_date", 0, "Deed of Trust Date: Recorded\n 01/{d}/2019", "2019-01-{d}"),
    ("deed_date", 1, "01/{d}/2019 {p}, A SINGLE MAN", "2019-01-{d}"),
    ("deed_date", 2, "Deed of Trust Information:\nDate: _ March {d}, 2019", "2019-03-{d}"),
    ("deed_date", 3, "on 01/{d}/2019, they executed a deed of trust", "2019-01-{d}"),
    ("deed_date", 4, "Deed of Trust dated: March {d}, 2019", "2019-03-{d}"),
    ("deed_date", 5, "Deed of Trust\nDate: March {d}, 2019", "2019-03-{d}"),
    ("deed_date", 6, "Deed of Trust Date: March {d}, 2019", "2019-03-{d}"),
    ("deed_date", 7, "Deed of Trust or contract lien dated 01/{d}/2019", "2019-01-{d}"),
    ("deed_date", 8, "executed March {d} 2019", "2019-03-{d}"),
    ("loan_doc", 0, "Recording Information: - Document No. {n}", "{n}"),
    ("loan_doc", 1, "Recording {n} Information:", "{n}"),
    ("loan_doc", 2, "Deed of Trust is recorded in X as volume {n}", "{n}"),
    ("loan_doc", 3, "Deed of Trust to X secorded under Clerk's File No. {n}", "{n}"),
    ("loan_doc", 4, "Deed of Trust Date: X. Recorded in: Y. Instrument No: {n}", "{n}"),
    ("loan_doc", 5, "Recorded in: Y. Instrument No. {n}", "{n}"),
    ("loan_doc", 7, "filed in X under Document # {n}", "{n}"),
    ("loan_mod_doc", 0, "modified by that certain Loan Modification Agreement number {n} in the official public records", "{n}"),
    ("loan_mod_doc", 1, "as affected by Loan Modification Agreements Instrument No(s). {n}", "{n}"),
    ("loan_mod_doc", 2, "as modified by Modification of Deed of Trust recorded under Instrument No. {n}", "{n}"),
    ("prop_address", 0, "commonly known as {h} SAMPLE {e} STREET, Robstown, TX 78380", "{h} SAMPLE {e} STREET"),
    ("prop_address", 1, "{h} {e} LANE 00112233\nROBSTOWN, TX 78380", "{h} {e} LANE"),
    ("prop_address", 2, "{h} {e} CT, BISHOP, TEXAS 78343", "{h} {e} CT"),
    ("prop_address", 3, "at the place {h} {e} ROAD, CORPUS CHRIST, TX 78401", "{h} {e} ROAD"),
    ("legal_subdivision", 0, "LOT FOUR (4), BLOCK TWO (2), {e}, A SUBDIVISION", "{e}"),
    ("legal_subdivision", 1, "Lot 7A, Block 3, {e} Addition", "{e}"),
    ("legal_subdivision", 2, "TRACTS ONE AND TWO, {e} ADDITION", "{e}"),
)

#: A pattern that an earlier one of its list always forestalls, and which that is: what it
#: finds is found there.
FORESTALLED = {("owner", 18): 7, ("loan_amount", 6): 2, ("loan_doc", 6): 0}
