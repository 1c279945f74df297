"""Known results: inputs and the values expected for them."""

# Market, five scores (demand, entry, regulatory, craft, e-commerce), GDP, size, then
# composite, tier, weighted priority, GDP score, final, potential, priority, entry tier.
MARKETS = """
    USA, 8.8, 8.2, 7.5, 8.5, 9.5, 65000, 5200.0, 8.5, Tier 2, 8.69, 7.7, 8.51, 10.0, 9.03, Tier 1 - Enter Now
    UAE, 8.5, 9.2, 8.8, 8.0, 8.8, 44000, 1400.0, 8.66, Tier 1, 8.47, 5.28, 8.36, 2.69, 6.38, Tier 2 - Plan Entry
    UK, 8.2, 8.5, 7.2, 7.5, 9.2, 46000, 1100.0, 8.12, Tier 2, 8.07, 5.51, 7.95, 2.12, 5.91, Tier 2 - Plan Entry
    Singapore, 7.8, 9.5, 9.0, 7.0, 9.0, 65000, 680.0, 8.46, Tier 2, 8.47, 7.7, 8.29, 1.31, 5.85, Tier 2 - Plan Entry
    Canada, 8.0, 8.2, 7.0, 8.0, 9.0, 52000, 980.0, 8.04, Tier 2, 8.09, 6.2, 7.94, 1.88, 5.82, Tier 2 - Plan Entry
    Australia, 7.5, 8.8, 8.0, 6.5, 8.8, 55000, 620.0, 7.92, Tier 2, 7.89, 6.55, 7.74, 1.19, 5.45, Tier 2 - Plan Entry
    Kuwait, 8.0, 8.8, 8.2, 7.5, 8.0, 38000, 420.0, 8.1, Tier 2, 7.9, 4.59, 7.8, 0.81, 5.35, Tier 2 - Plan Entry
    Saudi Arabia, 8.0, 7.8, 8.0, 7.0, 7.8, 27000, 840.0, 7.72, Tier 2, 7.42, 3.32, 7.36, 1.62, 5.35, Tier 3 - Monitor
    Ireland, 7.2, 8.0, 7.0, 7.0, 8.8, 85000, 360.0, 7.6, Tier 2, 8.02, 10.0, 7.78, 0.69, 5.3, Tier 2 - Plan Entry
    Malaysia, 7.8, 8.2, 7.8, 7.5, 8.5, 12000, 520.0, 7.96, Tier 2, 7.45, 1.6, 7.44, 1.0, 5.19, Tier 3 - Monitor
    Germany, 7.2, 6.8, 6.0, 4.5, 9.0, 51000, 1200.0, 6.7, Tier 3, 6.8, 6.09, 6.66, 2.31, 5.14, Tier 3 - Monitor
    New Zealand, 7.2, 9.0, 8.2, 6.0, 8.2, 42000, 310.0, 7.72, Tier 2, 7.51, 5.05, 7.4, 0.6, 5.02, Tier 3 - Monitor
    Sweden, 6.8, 7.5, 6.5, 4.5, 9.0, 56000, 480.0, 6.86, Tier 3, 6.95, 6.66, 6.79, 0.92, 4.74, Tier 3 - Monitor
    Netherlands, 6.5, 7.2, 6.2, 5.0, 8.8, 57000, 520.0, 6.74, Tier 3, 6.86, 6.78, 6.7, 1.0, 4.7, Tier 3 - Monitor
    France, 6.8, 6.5, 5.8, 4.0, 8.5, 44000, 920.0, 6.32, Tier 4, 6.35, 5.28, 6.23, 1.77, 4.67, Tier 4 - Avoid
    Japan, 6.0, 5.8, 5.0, 3.0, 9.2, 40000, 1400.0, 5.8, Tier 4, 5.8, 4.82, 5.69, 2.69, 4.64, Tier 4 - Avoid
    Italy, 6.8, 6.0, 5.5, 4.2, 8.0, 38000, 740.0, 6.1, Tier 4, 6.11, 4.59, 6.01, 1.42, 4.4, Tier 4 - Avoid
    Spain, 6.5, 6.5, 5.8, 4.0, 8.2, 34000, 680.0, 6.2, Tier 4, 6.1, 4.13, 6.02, 1.31, 4.37, Tier 4 - Avoid
    South Africa, 6.5, 6.8, 6.2, 5.5, 7.0, 6800, 280.0, 6.4, Tier 4, 5.97, 1.0, 5.96, 0.54, 4.06, Tier 4 - Avoid
    Portugal, 6.2, 7.2, 6.5, 3.5, 8.0, 24000, 280.0, 6.28, Tier 4, 5.98, 2.98, 5.92, 0.54, 4.04, Tier 4 - Avoid
"""

# Cost INR, FOB USD, domestic margin percent, list price INR.
PRODUCTS = """
    280, 15.0, 77.6, 896
    380, 20.0, 77.2, 1216
    420, 23.0, 78.1, 1344
    320, 18.0, 78.7, 1024
    480, 26.0, 77.9, 1536
    260, 16.0, 80.5, 832
    180, 12.0, 82.0, 576
    220, 14.0, 81.2, 704
    340, 19.0, 78.6, 1088
    680, 38.0, 78.6, 2176
    920, 48.0, 77.0, 2944
    380, 22.0, 79.3, 1216
    360, 20.0, 78.4, 1152
    420, 24.0, 79.0, 1344
    290, 17.0, 79.6, 928
    260, 16.0, 80.5, 832
    260, 16.0, 80.5, 832
    195, 13.0, 82.0, 624
    440, 25.0, 78.9, 1408
    380, 22.0, 79.3, 1216
    320, 18.0, 78.7, 1024
    280, 16.0, 79.0, 896
    480, 27.0, 78.7, 1536
    560, 32.0, 79.0, 1792
    520, 30.0, 79.2, 1664
    980, 56.0, 79.0, 3136
    620, 35.0, 78.8, 1984
    420, 24.0, 79.0, 1344
    380, 22.0, 79.3, 1216
    260, 15.0, 79.2, 832
    360, 21.0, 79.5, 1152
    580, 33.0, 79.0, 1856
    420, 24.0, 79.0, 1344
    320, 18.0, 78.7, 1024
    300, 17.0, 78.9, 960
    380, 22.0, 79.3, 1216
    180, 12.0, 82.0, 576
    440, 25.0, 78.9, 1408
    820, 46.0, 78.7, 2624
    1200, 68.0, 78.9, 3840
"""


def rows(text: str) -> list[list[str]]:
    return [[cell.strip() for cell in line.split(",")] for line in text.strip().splitlines()]
