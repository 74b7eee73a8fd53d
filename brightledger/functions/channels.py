"""Marketing channel of a traffic combination: an ordered rule table, first match wins.

A rule is (label, {test: patterns}). Tests, all of which must hold:
``source``/``medium``/``category`` any of the patterns, ``campaign`` all of the patterns,
``not_campaign``/``not_medium`` none of them, ``account`` one of the named ad accounts.
Patterns are LIKE patterns; a leading ``~`` ignores case, and a null never matches.
``{brand}``, ``{shop}`` and ``{own}`` stand for the shop's search term, sender prefix and link tag, and the
ad accounts are named, since all of these belong to the shop that uses the rules.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_VIDEO = {"source": ["google"], "account": ["video"]}
_YT = {"source": ["youtube.com", "yt-direct-leads"]}
_G = {"source": ["google"]}
_GR = {"source": ["google"], "account": ["remarketing"]}
_B = {"source": ["bing", "yahoo"]}
_FB = {"source": ["facebook%"]}
_NL = {"source": ["newsl%", "{shop}%", "Dynamic Yield recommendations"]}
_SMS = {"source": ["~sms"]}
_CRI = {"source": ["cri%"]}
_GEM = {"source": ["gemini%"]}
_TBL = {"source": ["tbl%", "taboola%"]}
_PIN = {"source": ["pint%"]}

# Channel names and the patterns that select them, in order of precedence.
RULES: list[tuple[str, dict]] = [
    # search and video
    ("Youtube Geox", {**_VIDEO, "campaign": ["~%geox%"]}),
    ("Youtube Geox", {**_YT, "campaign": ["~%geox%"]}),
    ("Youtube Contacts", {**_VIDEO, "campaign": ["%contact%"]}),
    ("Youtube Contacts", {**_YT, "campaign": ["%contact%"]}),
    ("Youtube", _VIDEO),
    ("Youtube", _YT),
    ("Youtube", {**_G, "campaign": ["%trueview%"]}),
    ("Youtube", {"account": ["remarketing"], "campaign": ["%yt%"]}),
    ("Google Generic - HTO", {**_G, "campaign": ["%hto%"]}),
    ("Google Discovery - Contacts", {**_G, "campaign": ["%discovery%", "%contact%"]}),
    ("Google Discovery", {**_G, "campaign": ["%discovery%"]}),
    ("Google GDN", {**_G, "account": ["gdn"]}),
    ("YouTube Unskipable", {**_G, "account": ["unskippable"]}),
    ("Google Retargeting AU/CA", {**_GR, "campaign": ["%rmkt%", "au%"]}),
    ("Google Retargeting AU/CA", {**_GR, "campaign": ["%rmkt%", "ca%"]}),
    ("Google Retargeting", {**_GR, "campaign": ["%rmkt%"]}),
    ("Google GDN", _GR),
    ("Google Organic", {**_G, "medium": ["organic"]}),
    ("Google Private Label P.Max - Contacts", {**_G, "campaign": ["%conta%", "%p.max%", "%private lab%"]}),
    ("Google P.Max - Contacts", {**_G, "campaign": ["%conta%", "%p.max%"], "not_campaign": ["%private lab%"]}),
    ("Google Private Label - Contacts", {**_G, "campaign": ["%conta%", "%private lab%"]}),
    ("Google PLA AU", {**_G, "campaign": ["%pla%", "au%"]}),
    ("Google PLA CA", {**_G, "campaign": ["%pla%", "ca%"]}),
    ("Google PLA Contacts", {**_G, "campaign": ["%pla%", "%conta%"]}),
    ("Google PLA", {**_G, "campaign": ["%pla%"]}),
    ("Google Brand AU", {**_G, "campaign": ["%{brand}%", "au%"]}),
    ("Google Brand CA", {**_G, "campaign": ["%{brand}%", "ca%"]}),
    ("Google Brand", {**_G, "campaign": ["%{brand}%"]}),
    ("Google Brand", {**_G, "campaign": ["%Bid Brad Abs Top Imp Share%"]}),
    ("Google Generic AU", {**_G, "campaign": ["au%"]}),
    ("Google Generic CA", {**_G, "campaign": ["ca%"]}),
    ("Google Generic - Contacts", {**_G, "campaign": ["%contact%"], "not_campaign": ["%pla%"]}),
    ("Google - DV360", {"source": ["dfa", "dbm"]}),
    ("Google Generic", _G),
    ("Bing Private Label - Contacts", {**_B, "campaign": ["%conta%", "%private lab%"]}),
    ("Bing PLA - Contacts", {**_B, "campaign": ["~%pla %", "%conta%"]}),
    ("Bing PLA", {**_B, "campaign": ["~%pla %"]}),
    ("Bing Generic - Contacts", {**_B, "campaign": ["%contact%"]}),
    ("Bing Aud Net - HTO", {**_B, "campaign": ["%audience-network%", "%hto%"]}),
    ("Bing Aud Net", {**_B, "campaign": ["%audience-network%"]}),
    ("Bing Brand AU", {**_B, "campaign": ["%{brand}%", "au%"]}),
    ("Bing Brand CA", {**_B, "campaign": ["%{brand}%", "ca%"]}),
    ("Bing Brand", {**_B, "campaign": ["%{brand}%"]}),
    ("Bing Generic AU", {**_B, "campaign": ["au%"]}),
    ("Bing Generic CA", {**_B, "campaign": ["ca%"]}),
    ("Bing Organic", {**_B, "medium": ["organic"]}),
    ("Bing Generic", _B),
    # social
    ("Facebook Subs", {**_FB, "campaign": ["%subs%"]}),
    ("Facebook Cust", {**_FB, "medium": ["fb-cust"]}),
    ("Facebook Retargeting", {**_FB, "medium": ["fb-rtgt", "rtrgt"]}),
    ("Facebook Subs", {**_FB, "medium": ["fb-subs"]}),
    ("Facebook Retargeting", {**_FB, "campaign": ["%rtgt%"]}),
    ("Facebook Retention", {**_FB, "campaign": ["%rmkt%"]}),
    ("Facebook NAQ - HTO", {**_FB, "campaign": ["%hto%"]}),
    ("Facebook Trans", {**_FB, "campaign": ["%transition%"]}),
    ("Facebook TS", {**_FB, "campaign": ["ts%"]}),
    ("Facebook TS", {**_FB, "campaign": ["tube%"]}),
    ("Facebook Contacts", {**_FB, "campaign": ["%conta%"]}),
    ("Facebook NAQ - Lux", {**_FB, "campaign": ["%lux%"], "not_campaign": ["%notlux%"]}),
    ("Facebook NAQ - Lux", {**_FB, "campaign": ["%oakley%"], "not_campaign": ["%notlux%"]}),
    ("Facebook NAQ - Lux", {**_FB, "campaign": ["%ray%"], "not_campaign": ["%notlux%"]}),
    ("Facebook Chase", {**_FB, "campaign": ["%chase-%"]}),
    ("Facebook Chase", {**_FB, "campaign": ["%_chase_%"]}),
    ("Facebook NAQ - Social Method", {**_FB, "campaign": ["sm%"]}),
    ("Facebook Customers", {**_FB, "campaign": ["%cust%"]}),
    ("Facebook Fans", {**_FB, "medium": ["fb-organic"], "campaign": ["%fans%"]}),
    ("Facebook Organic", {**_FB, "medium": ["fb-organic"]}),
    ("Facebook Brand", {**_FB, "not_medium": ["fb-sponsored", "fb-rtgt", "fb-sponsered", "fb-cust", "rtrgt",
                                              "fb-subs", "fb-spo", "fb-sponsore", "fb-rmkt"]}),
    ("Facebook Ref", {"source": ["~m.facebook.com", "~l.facebook.com"]}),
    ("Instagram Ref", {"source": ["~l.instagram.com"]}),
    ("Facebook NAQ", _FB),
    # newsletters and text messages
    ("Newsletter Abn Trigger", {**_NL, "category": ["Cart Abandon", "Category Abandon", "Product Abandon"]}),
    ("Newsletter Glasses Retention", {**_NL, "category": ["Retention", "Bulk Churned", "Churned",
                                                          "Cashback Reorder", "Post Purchase"]}),
    ("Newsletter Glasses NAQ", {**_NL, "category": ["Leads", "Multi", "Workflow", "Bulk Non Specified",
                                                    "Re-Engagement", "Welcome", "Bulk Welcome", "Other",
                                                    "Prescription Scanner"]}),
    ("Newsletter Contacts Retention", {**_NL, "category": ["Post Purchase Contact Lenses"]}),
    ("Newsletter Contacts NAQ", {**_NL, "category": ["Contacts", "Contacts Other"]}),
    ("Newsletter Other", _NL),
    ("SMS Contacts Abn", {**_SMS, "medium": ["~cart\\_abandonment"], "campaign": ["~%contact%"]}),
    ("SMS Glasses Abn", {**_SMS, "medium": ["~cart\\_abandonment"]}),
    ("SMS Contacts Retention", {**_SMS, "medium": ["~%reorder%"], "campaign": ["~%contact%"]}),
    ("SMS Glasses Retention", {**_SMS, "medium": ["~%reorder%"]}),
    ("SMS Contacts Welcome", {**_SMS, "medium": ["~%sms_keyword_banner%", "~%sms_welcome%"],
                              "campaign": ["~%contact%"]}),
    ("SMS Glasses Welcome", {**_SMS, "medium": ["~%sms_keyword_banner%", "~%sms_welcome%"]}),
    ("SMS Contacts Manual", {**_SMS, "medium": ["~%manual%"], "campaign": ["~%contact%"]}),
    ("SMS Glasses Manual", {**_SMS, "medium": ["~%manual%"]}),
    ("SMS Other", _SMS),
    ("Cordial Newsletter", {"source": ["~cordial"]}),
    ("Box Insert", {"source": ["~box\\_insert"]}),
    # partners
    ("Partnerships", {"source": ["cj%", "ir%", "groupon.com", "~addshoppers", "~%paypal%"]}),
    ("Criteo NAQ", {"source": ["~cri%"], "medium": ["~%naq%"]}),
    ("Criteo Mid", {**_CRI, "campaign": ["%mid%"]}),
    ("Criteo - Lower Funnel - Contacts", {**_CRI, "medium": ["%contact%"]}),
    ("Criteo - Lower Funnel", _CRI),
    ("Criteo - Lower Funnel", {"source": ["ads.us.criteo.com"]}),
    ("Gemini - Native", {**_GEM, "medium": ["synd", "native"]}),
    ("Gemini - RTGT", {**_GEM, "medium": ["rtgt"]}),
    ("Gemini NAQ", {**_GEM, "medium": ["~naq"]}),
    ("Gemini NAQ", {"source": ["yahoo"], "medium": ["~cpc"]}),
    ("Gemini Organic", {"source": ["yahoo"], "medium": ["~organic"]}),
    ("Gemini Search", _GEM),
    ("Grin", {"source": ["~grin"]}),
    ("Grin", {"medium": ["~grin"]}),
    ("Influencers", {"source": ["youtube", "ltb", "blog", "podcast"]}),
    ("Influencers", {"medium": ["youtube"]}),
    ("Influencers", {"source": ["instagram%"], "not_medium": ["social%", "{own}%", "%organic%", "(not set)"]}),
    ("Influencers", {"source": ["tiktok"], "not_medium": ["%sponsored%", "%referral%", "%{own}-%", "%rtgt%"]}),
    ("Instagram", {"source": ["instagram%"]}),
    ("Tiktok", {"source": ["~%tiktok%"]}),
    # native
    ("Liveintent Transitions", {"source": ["livei%"], "campaign": ["~%trans%"]}),
    ("Liveintent", {"source": ["livei%"]}),
    ("Media Force", {"source": ["mediaf%"]}),
    ("Power Inbox", {"source": ["poweri%"]}),
    ("Twitter Organic", {"source": ["twitter%"], "medium": ["twitter-organic"]}),
    ("Twitter", {"source": ["twitter%"]}),
    ("Triplelift", {"source": ["triplel%"]}),
    ("SnapChat", {"source": ["snap%"]}),
    ("Outbrain", {"source": ["out%", "ob"]}),
    ("Taboola - RTGT", {**_TBL, "medium": ["~%rtgt%"]}),
    ("Taboola - HTO", {**_TBL, "campaign": ["%hto%"]}),
    ("Taboola", _TBL),
    ("Pinterest RMKT", {**_PIN, "medium": ["%remarketing%"]}),
    ("Pinterest RTGT", {**_PIN, "medium": ["%retargeting%"]}),
    ("Pinterest Organic", {**_PIN, "medium": ["pint\\_organic", "posts", "social", "fb-organic",
                                              "pinterest-organic"]}),
    ("Pinterest Shop", {**_PIN, "medium": ["~%shop%", "~%referral%"]}),
    ("Pinterest NAQ", _PIN),
    # single settings
    ("TVsquared", {"source": ["%tvsquared%"]}),
    ("Direct", {"source": ["(direct)"]}),
    ("Brand", {"source": ["social%"]}),
    ("Unknown", {"source": ["(not set)"]}),
    ("Unknown", {"source": ["ref%", "undefined"]}),
    ("MuseHD", {"source": ["muse%"]}),
    ("Organic", {"source": ["organic"]}),
    ("Vizury", {"source": ["vizury"]}),
    ("ShopMessage", {"source": ["shopmessage"]}),
    ("Amazon", {"source": ["amazon"]}),
    ("TV", {"source": ["tv"]}),
    ("Organic", {"medium": ["organic"]}),
    ("Lifescript", {"source": ["life%"]}),
]


def channel(source: Column, medium: Column, campaign: Column, account: Column, category: Column, *,
            brand: str, shop: str, accounts: Mapping[str, int], own_tag: str = "shop",
            rules: list[tuple[str, dict]] | None = None) -> Column:
    """Channel name of a combination as one CASE expression, ``Other`` if no rule holds."""
    fields = {"source": source, "medium": medium, "campaign": campaign, "category": category}

    def like(field: str, pattern: str) -> Column:
        text = pattern.lstrip("~").replace("{brand}", brand).replace("{shop}", shop).replace("{own}", own_tag)
        value = F.lower(fields[field]) if pattern.startswith("~") else fields[field]
        return value.like(text)

    def predicate(tests: dict) -> Column:
        parts = []
        for test, patterns in tests.items():
            if test == "account":
                parts.append(account.isin([accounts[a] for a in patterns if a in accounts]))
            elif test == "campaign":
                parts += [like("campaign", p) for p in patterns]
            elif test.startswith("not_"):
                parts += [~like(test[4:], p) for p in patterns]
            else:
                parts.append(reduce(lambda a, b: a | b, [like(test, p) for p in patterns]))
        return reduce(lambda a, b: a & b, parts)

    out = None
    for label, tests in RULES if rules is None else rules:
        hit = predicate(tests)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit("Other") if out is None else out.otherwise("Other")
