"""Hand-built raw feed documents (our own matches, players and prices)."""

import json

TAB_DOC = {
    "matches": [
        {"name": "Brisbane v Melbourne", "startTime": "2025-03-06T09:00:00.000Z", "markets": [
            {"betOption": "Head To Head", "propositions": [
                {"id": 11, "name": "Brisbane", "returnWin": 2.1},
                {"id": 12, "name": "Melbourne", "returnWin": 1.75}]},
            {"betOption": "Line", "propositions": [
                {"id": 21, "name": "Brisbane +2.5", "returnWin": 1.9},
                {"id": 22, "name": "Melbourne -2.5", "returnWin": 1.9}]},
            {"betOption": "Pick Your Own Line", "propositions": [
                {"id": 23, "name": "Brisbane +6.5", "returnWin": 1.5},
                {"id": 24, "name": "Melbourne -6.5", "returnWin": 2.6},
                {"id": 25, "name": "Brisbane +2.5", "returnWin": 1.9},
                {"id": 26, "name": "Brisbane +0", "returnWin": 2.0},
                {"id": 27, "name": "Melbourne +0", "returnWin": 1.8}]},
            {"betOption": "Total Points Over/Under", "propositions": [
                {"id": 31, "name": "Over 42.5", "returnWin": 1.9},
                {"id": 32, "name": "Under 42.5", "returnWin": 1.9}]},
            {"betOption": "Pick Your Own Total", "propositions": [
                {"id": 33, "name": "Over 36.5", "returnWin": 1.45},
                {"id": 34, "name": "Under 36.5", "returnWin": 2.65},
                {"id": 35, "name": "Over 50.5", "returnWin": 3.1}]},
            {"betOption": "To Score a Try", "propositions": [
                {"id": 41, "name": "Ari Tane (BRI)", "returnWin": 1.8},
                {"id": 42, "name": "Nasiah W-Milera (MEL)", "returnWin": 2.2}]},
            {"betOption": "2+ Tries", "propositions": [
                {"id": 43, "name": "Ari Tane (BRI)", "returnWin": 6.0}]},
            {"betOption": "1st Try Scorer", "propositions": [
                {"id": 51, "name": "Ari Tane (BRI)", "returnWin": 8.0},
                {"id": 52, "name": "Ben Ola (MEL)", "returnWin": 8.0}]},
            {"betOption": "Time of First Try", "propositions": [
                {"id": 61, "name": "8:00 or Earlier", "returnWin": 2.4},
                {"id": 62, "name": "8:00 or later", "returnWin": 1.55}]},
            {"betOption": "Empty Market", "propositions": []},
        ]},
        {"name": "Souths v Sharks", "startTime": "2025-03-07T08:00:00.000Z", "markets": [
            {"betOption": "Head To Head", "propositions": [
                {"id": 111, "name": "Souths", "returnWin": 1.6},
                {"id": 112, "name": "Sharks", "returnWin": 2.35}]},
            {"betOption": "Time of First Try", "propositions": [
                {"id": 161, "name": "8:00 or later", "returnWin": 1.5}]},
        ]},
    ]
}


def sb_market_doc(match_id):
    """Sportsbet-style markets of one match (line + totals + players)."""
    return [
        {"name": "Line", "externalId": 900, "selections": [
            {"name": "Broncos (+2.5)", "resultType": "H", "externalId": 1, "price": {"winPrice": 1.9}},
            {"name": "Storm (-2.5)", "resultType": "A", "externalId": 2, "price": {"winPrice": 1.9}},
            {"name": "Broncos (-4.5)", "resultType": "H", "externalId": 3, "price": {"winPrice": 2.75}},
            {"name": "Storm (+4.5)", "resultType": "A", "externalId": 4, "price": {"winPrice": 1.42}},
            {"name": "Broncos (0.0)", "resultType": "H", "externalId": 5, "price": {"winPrice": 2.0}},
            {"name": "Storm (0.0)", "resultType": "A", "externalId": 6, "price": {"winPrice": 1.8}}]},
        {"name": "Total Match Points", "externalId": 901, "selections": [
            {"name": "Over", "resultType": "O", "externalId": 7, "unformattedHandicap": "42.5",
             "price": {"winPrice": 1.9}},
            {"name": "Under", "resultType": "U", "externalId": 8, "unformattedHandicap": "42.5",
             "price": {"winPrice": 1.9}}]},
        {"name": "Total Match Tries", "externalId": 902, "selections": [
            {"name": "Tries Over 7.5", "resultType": "O", "externalId": 9, "price": {"winPrice": 1.85}},
            {"name": "Tries Under 7.5", "resultType": "U", "externalId": 10, "price": {"winPrice": 1.95}},
            {"name": "Tries Over 9.5", "resultType": "O", "externalId": 11, "price": {"winPrice": 3.0}}]},
        {"name": "To Score 2+ Tries", "externalId": 903, "selections": [
            {"name": "Ari Tane", "resultType": "-", "externalId": 12, "price": {"winPrice": 6.5}}]},
        {"name": "Player Tries Over/Under", "externalId": 904, "selections": [
            {"name": "Ari Tane Over 0.5", "resultType": "O", "externalId": 13, "price": {"winPrice": 1.8}},
            {"name": "Ari Tane Under 0.5", "resultType": "U", "externalId": 14, "price": {"winPrice": 1.95}}]},
        {"name": "First Try Scorer", "externalId": 905, "selections": [
            {"name": "Ari Tane", "resultType": "-", "externalId": 15, "price": {"winPrice": 8.5}},
            {"name": "Ben Ola", "resultType": "-", "externalId": 16}]},
        {"name": "Time of First Try", "externalId": 906, "selections": [
            {"name": "0-10 Minutes", "resultType": "-", "externalId": 17, "price": {"winPrice": 2.5}},
            {"name": "11-20 Minutes", "resultType": "-", "externalId": 18, "price": {"winPrice": 3.4}},
            {"name": "No Try", "resultType": "-", "externalId": 19, "price": {"winPrice": 51.0}}]},
    ]


SB_EVENT_URL = "https://api.example.com/sportsbook/Events/{id}/MarketGroupings/313/Markets"


ENDPOINTS = {"Line": 313, "Total Match Points": 108, "Total Match Tries": 110, "Time of First Try": 205}


def sb_landed(match_id, main=False):
    """(url, body) of each endpoint's response; with ``main`` also one that lists every market again."""
    doc, by = sb_market_doc(match_id), {}
    for market in doc:
        by.setdefault(ENDPOINTS.get(market["name"], 112), []).append(market)
    if main:
        by[101] = doc
    return [(SB_EVENT_URL.format(id=match_id).replace("313", str(n)), json.dumps(rows)) for n, rows in by.items()]


def landed_lines(records):
    return "\n".join(json.dumps({"url": u, "body": b}) for u, b in records) + "\n"


LISTING_HTML = """<html><body>
<div class="White_fqa53j6 card"><div class="top"><span class="oneLine_f15ay66x">Thursday, 6 Mar 20:00</span></div>
 <div class="participantText_fivg86r">Broncos</div><div class="participantText_fivg86r">Storm</div>
 <span class="priceTextSize_frw9zm9">2.10</span><span class="priceTextSize_frw9zm9">1.75</span>
 <a class="linkMultiMarket_fcmecz0" href="/betting/rugby-league/premiership/broncos-v-storm-9123456">More</a></div>
<div class="White_fqa53j6 card"><div class="top"><span class="oneLine_f15ay66x">Friday, 7 Mar 19:00</span></div>
 <div class="participantText_fivg86r">Rabbitohs</div><div class="participantText_fivg86r">Sharks</div>
 <span class="priceTextSize_frw9zm9">1.60</span><span class="priceTextSize_frw9zm9">2.35</span>
 <a class="linkMultiMarket_fcmecz0" href="/betting/rugby-league/premiership/rabbitohs-v-sharks-9123457">More</a></div>
</body></html>"""
