"""How the codings of the survey variables map onto the common categories.

Fixed values: code tables of the sources, as `(codes, target position)`; see functions/recode.py.
"""

from __future__ import annotations

from panelweave.functions.recode import SAME, Minus, Plus, Span, Tens

# yes/no items
YES_FIRST = [([1, 2], Minus(3))]
YES_IS_ONE = [([0, 1], Plus(1))]
YES_ONE_NO_TWO_THREE = [([1], 2), ([2, 3], 1)]

# sexual orientation, two listings
ORIENTATION_REVERSED = [([1, 4], SAME), ([2, 3], Minus(5))]
ORIENTATION_SCALE = [([1, 2], 1), ([3], 2), ([4, 5], 3), ([6], 4)]

# sex and ethnicity
SEX_TWO = [([1, 2], SAME)]
ETHNIC_SIX = [(Span(1, 6), SAME)]
ETHNIC_EIGHT = [(Span(1, 3), SAME), (Span(4, 5), 4), (Span(6, 7), 5), ([8], 6)]
ETHNIC_SIXTEEN = [
    (Span(1, 3), 1),
    (Span(4, 7), 2),
    ([8], 3),
    (Span(9, 10), 4),
    (Span(12, 14), 5),
    ([11, 15, 16], 6),
]
ETHNIC_BIRTH_COUNTRY = [(Span(1, 2), 1), ([3, 6], 5)]
ETHNIC_AGE_16 = [(Span(1, 3), 1), ([4], 5), ([5], 3), (Span(6, 7), 4)]
ETHNIC_AGE_16_OBSERVED = [([1], 1), ([2], 5), ([5], 2), ([6], 6)]

# marital status
SINGLE_FIRST = [([1], 1), ([2, 3], 2), ([4, 5, 6], Plus(-1))]
MARRIED_FIRST = [([1], 2), ([2, 3], 1), ([4, 5, 6], Plus(-1))]
SINGLE_FIRST_PARTNER_TO_8 = [*SINGLE_FIRST, ([7, 8], Plus(-4))]
SINGLE_FIRST_PARTNER_TO_9 = [*SINGLE_FIRST, ([7, 8, 9], Plus(-4))]
DERIVED_MARITAL = [([1], 3), ([2], 2), ([3, 4], Plus(1)), ([5], 2), ([6, 7], Plus(-2)), ([8], 1)]
MARITAL_NINE = [([1], 1), ([2, 6], 2), ([3, 7], 3), ([4, 8], 4), ([5, 9], 5)]
FIRST_FIVE = [([1, 2, 3, 4, 5], SAME)]

# religion
RELIGION_TEEN = [([1, 2, 3], 2), ([4, 5], Plus(-1)), ([6, 7], Minus(12)), ([8], 7), ([10], 1)]
RELIGION_27 = [(list(range(2, 23)), 2), ([23], 4), ([24], 7), ([25], 3), ([26, 27], Plus(-21))]
RELIGION_14 = [([1], 1), (list(range(2, 10)), 2), ([10], 4), ([11], 7), ([12], 3), ([13, 14], Plus(-8))]
RELIGION_13 = [([1], 1), (list(range(2, 9)), 2), ([9], 4), ([10], 7), ([11], 3), ([12, 13], Plus(-7))]
NO_RELIGION_IS_TWO = [([2], 1)]
RELIGION_SIX = [([1], 2), ([2], 6), ([3], 4), ([4], 7), ([5], 3), ([6], 5)]
RELIGION_EIGHT = [([1, 2, 3], 2), ([4], 6), ([5], 4), ([6], 7), ([7], 3), ([8], 5)]
RELIGION_CHILD_ENGLAND_WALES = [([1, 2, 4], SAME), ([6], 3), ([7], 5), ([3], 6), ([5], 7)]
RELIGION_CHILD_SCOTLAND = [([1], 1), ([2, 3, 4], 2), ([5], 3), ([9], 4), ([7], 5), ([6], 6), ([8], 7)]
RELIGION_CHILD_NORTHERN_IRELAND = [([6], 1), ([1, 2, 3, 4], 2)]
RELIGION_PARENT = [([8], 1), ([1, 2, 3, 4], Plus(1)), ([5, 6], Minus(12))]
RELIGION_WAVE_1_TO_7 = [1, 2, 6, 4, 7, 3, 5, None]
RELIGION_WAVE_8 = [2, 3, 4, 5, 7, 6, None, 1]

# social class
NSSEC_SEVEN = [([1, 2], 1), ([3, 4, 5], Plus(-1)), ([6, 7], 5)]
NSSEC_EIGHT = [(Span(1, 2), 1), ([3, 4, 5], Plus(-1)), ([6, 7], 5), ([8], 6)]
NSSEC_BY_POSITION = [1, 1, 2, 3, 4, 5, 5, 6]
NSSEC_FIVE = [1, 2, 3, 4, 5]
CLASS_AT_BIRTH = [([1], 7), ([3, 4, 5, 6, 7, 8], Minus(9))]
CLASS_SIX_REVERSED = [([1, 2, 3, 4, 5, 6], Minus(7))]
CLASS_SIX = [([1, 2, 3, 4, 5, 6], SAME)]
CLASS_TWO_DIGIT_RANGES = [(list(range(10, 21)), Tens()), ([31, 32], Plus(-28)), (list(range(40, 51)), Tens(1))]
CLASS_TWO_DIGIT_CODES = [([10, 20], Tens()), ([31, 32], Plus(-28)), ([40, 50], Tens(1))]
CLASS_WITH_31_32 = [([1, 2], SAME), ([3.1], 3), ([3.2], 4), ([4, 5], Plus(1))]
CLASS_PARENT_AT_BIRTH = [([2, 3, 4, 5, 6, 7], Plus(-1))]
CLASS_AGE_7 = [([2, 3, 4, 5], Plus(-1)), ([6, 7, 8], Plus(-2))]
CLASS_PARENT_AT_16 = [([1, 2, 3, 4, 5], SAME), ([6, 7], Plus(-1))]
CLASS_AGE_23 = [([11], 1), ([21], 2), ([31], 3), ([32], 4), ([41, 42], 5), ([52], 6)]

# country
COUNTRY_FOUR = [(Span(1, 4), SAME)]
COUNTRY_WAVE_10 = [([1, 3], SAME), ([2], 4), ([4], 2)]
REGION_EARLY = [(Span(1, 9), 1), (Span(10, 11), Plus(-8))]
REGION_LATE = [(Span(1, 8), 1), (Span(9, 10), Plus(-7))]

# special needs
SEN_AGE_7_OTHER = [([1, 2, 4, 5, 6, 7, 8, 10, 11, 12], 1)]
