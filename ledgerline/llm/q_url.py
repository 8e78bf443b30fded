"""op5: verdicts for every page's url."""

from __future__ import annotations

from ledgerline.llm import url_filter as u
from ledgerline.llm.common import read, register

RULES = (u.Rule("net", "/", u.BLOCK), u.Rule("example.net", "/en/", u.ALLOW),
         u.Rule("example.com", "/de/", u.BLOCK), u.Rule("org", "/fr/", u.ALLOW))


@register("op5_url_filter")
def op5_url_filter(spark, sf_dir):
    return u.filter_urls(read(spark, sf_dir, "pages").select("page_id", "url"), RULES)
