"""Plain forms of the price and currency patterns: what the linear forms in ``fixed`` have to match."""

# --- Fixed values: price patterns in order of trust, with the value group ----------
PRICE_PATTERNS = [
    (r"""([^:\-_?!\w]*)(product:price:amount)[^:\-_?!\w]*content[:=]*[^:\-_?!\w]*(\d+([.,]\d+)*)""", 3),
    (r"""([^:\-_?!\w]*)(regularprice)[^:\-_?!\w]*content[:=]*[^:\-_?!\w]*(\d+([.,]\d+)*)""", 3),
    (r"""[^:\-_?!\w]*(price(01|02)*)[^:\-_?!\w]*[=:{'"><_\s]*amount([=:{'"><_\s]*)(\d+([.,]\d+)*)""", 4),
    (r"""[^:\-_?!\w]*(regularprice)[^:\-_?!\w]*[=:{'"><_\s]*amount([=:{'"><_\s]*)(\d+([.,]\d+)*)""", 3),
    (r"""price-amount amount[><:='"\s]*<bdi>(\d+([.,]\d+)*)""", 1),
    (r""""price" style="display:none;">(\d+([.,]\d+)*)""", 1),
    (r"""([^:\-_?!\w]price)[^\-_\w]current([^\-_\w]*)[:=]([^\-_\w]*)(\d+([.,]\d+)*)""", 4),
    (r"""[^:\-_?!\w](price(01|02)*)[^\-_\w]*[:=][^\-_\w]*(\d+([.,]\d+)*)""", 3),
    (r"""[^:\-_?!\w](regularprice)[^\-_\w]*[:=][^\-_\w]*(\d+([.,]\d+)*)""", 2),
    (r"""[^:\-_?!\w](price(01|02)*)[^\-_\w]*(content)[^\-_\w]*(\d+([.,]\d+)*)""", 4),
    (r"""[^:\-_?!\w](price(01|02)*)[^\-_\w]*(data-product-price)[^\-_\w]*(\d+([.,]\d+)*)""", 4),
    (r"""[^:\-_?!\w](regularprice)[^\-_\w]*(value)[^\-_\w]*(\d+([.,]\d+)*)""", 3),
    (r"""["'><_\s]*formattedvalue(["'\s:=]*)[$£¥円€a-z\s]*(\s)*(\d+([.,]\d+)*)""", 3),
    (r"""["'><_\s]*price_formatted(["'\s:=]*)[$£¥円€a-z\s]*(\s)*(\d+([.,]\d+)*)""", 3),
    (r"""['"><_\s]*price(01|02)*(["'\s:=]*)[$£¥円€a-z\s]*(\d+([.,]\d+)*)""", 3),
    (r"""([^:\-_?!\w]pricetotal:)[^:\-_?!\w](initialize\()(\d+([.,]\d+)*)(\))""", 3),
    (r"""[^:\-_?!\w](price(01|02)*)([^:\-_?!\w]*)[:=]*[^:\-_?!\w]*(\d+([.,]\d+)*)""", 4),
    (r"""[^:\-_?!\w](regularprice)([^:\-_?!\w]*)[:=]*[^:\-_?!\w]*(\d+([.,]\d+)*)""", 3),
    (r"""([^:\-_?!\w]*)(price(01|02)*)[^:\-_?!\w]*content[:=]*[^:\-_?!\w]*(\d+([.,]\d+)*)""", 4),
    (r"""(price(01|02)*)([^:\-_?!\w]*)[:=]*[^:\-_?!\w]*(\d+([.,]\d+)*)""", 4),
    (r"""[^:\-_?!\w](pricecol)['"\s><]*span['"\s<>]*[\D]*(\d+([.,]\d+)*)""", 2),
]

# --- Fixed values: currency patterns in order of trust, with the value group -------
CURRENCY_PATTERNS = [
    (r"""[^:\-_?!\w](currency)['"\s]*[:=]['"\s]*([\w$€£¥円]*)""", 2),
    (r"""[^:\-_?!\w](price(\s*)currency)['"\s]*[:=]['"\s]*([\w$€£¥円]*)""", 3),
    (r"""[^:\-_?!\w](currency(\s)*code)['"\s]*[:=]['"\s]*([\w$€£¥円]*)""", 3),
    (r"""[^:\-_?!\w](currency(\s*)symbol)['"\s]*[:=]['"\s]*([\w$€£¥円]*)""", 3),
    (r"""[^:\-_?!\w](currency_code)['"\s]*[:=]['"\s]*([\w$€£¥円]*)""", 2),
    (r"""[^:\-_?!\w](currencyiso)['"\s]*[:=]['"\s]*([\w$€£¥円]*)""", 2),
    (r"""[^:\-_?!\w](currency(\s*)type)['"\s]*[:=]['"\s]*([\w$€£¥円]*)""", 3),
    (r"""[^:\-_?!\w](product(\s)*currency)['"\s]*content[:='"\s]*([\w$€£¥円]*)""", 3),
    (r"""[^:\-_?!\w](price(\s*)currency)['"\s]*content[:='"\s]*([\w$€£¥円]*)""", 3),
    (r"""[^:\-_?!\w](currency(\s)*code)['"\s]*content[:='"\s]*([\w$€£¥円]*)""", 3),
    (r"""[^:\-_?!\w](currency(\s*)symbol)['"\s]*content[:='"\s]*([\w$€£¥円]*)""", 3),
    (r"""[^:\-_?!\w](currency_code)['"\s]*content[:='"\s]*([\w$€£¥円]*)""", 2),
    (r"""[^:\-_?!\w](product:price:currency)['"\s]*content[:='"\s]*([\w$€£¥円]*)""", 2),
    (r"""[^:\-_?!\w](og:price:currency)['"\s]*content[:='"\s]*([\w$€£¥円]*)""", 2),
    (r"""[^:\-_?!\w](currency)['"\s]*content[:='"\s]*([\w$€£¥円]*)""", 2),
    (r"""[^:\-_?!\w](product(\s)*currency)['"\s]*value[:='"\s]*([\w$€£¥円]*)""", 3),
    (r"""[^:\-_?!\w](price(\s*)currency)['"\s]*value[:='"\s]*([\w$€£¥円]*)""", 3),
    (r"""[^:\-_?!\w](currency(\s)*code)['"\s]*value[:='"\s]*([\w$€£¥円]*)""", 3),
    (r"""[^:\-_?!\w](currency(\s*)symbol)['"\s]*value[:='"\s]*([\w$€£¥円]*)""", 3),
    (r"""[^:\-_?!\w](currency_code)['"\s]*value[:='"\s]*([\w$€£¥円]*)""", 2),
    (r"""[^:\-_?!\w](product:price:currency)['"\s]*value[:='"\s]*([\w$€£¥円]*)""", 2),
    (r"""[^:\-_?!\w](og:price:currency)['"\s]*value[:='"\s]*([\w$€£¥円]*)""", 2),
    (r"""[^:\-_?!\w](currency)['"\s]*value[:='"\s]*([\w$€£¥円]*)""", 2),
    (r"""[^:\-_?!\w](product(\s)*currency)['"\s]*(&quot;:)*['"\s:=]*([\w$€£¥円]*)""", 4),
    (r"""[^:\-_?!\w](price(\s*)currency)['"\s]*(&quot;:)*['"\s:=]*([\w$€£¥円]*)""", 4),
    (r"""[^:\-_?!\w](currency(\s)*code)['"\s]*(&quot;:)*['"\s:=]*([\w$€£¥円]*)""", 4),
    (r"""[^:\-_?!\w](currency(\s*)symbol)['"\s]*(&quot;:)*['"\s:=]*([\w$€£¥円]*)""", 4),
    (r"""[^:\-_?!\w](currency)['"\s]*(&quot;:)*['"\s:=]*([\w$€£¥円]*)""", 3),
    (r"""[^:\-_?!\w](currency_code)['"\s]*(&quot;:)*['"\s:=]*([\w$€£¥円]*)""", 3),
    (r"""[^:\-_?!\w](price_currency)['"\s]*(&quot;:)*['"\s:=]*([\w$€£¥円]*)""", 3),
    (r"""\W(price(01|02)*)['"><_\s:=]*([\w$€£¥円]+)""", 3),
    (r"""\W(regularprice)['"><_\s:=]*([\w$€£¥円]+)""", 2),
    (r"""\W(regularpriceamount)['"><_\s:=]*([\w$€£¥円]+)""", 2),
    (r"""\W(pricetotal)['"><_\s:=]*([\w$€£¥円]+)""", 2),
    (r"""\W(formattedvalue)['"><_\s:=]*([\w$€£¥円]+)""", 2),
    (r"""[^:\-_?!\w](pricecol)['"\s]*<span>['"\s]*([\w$€£¥円]*)""", 2),
    (r"""\W(price(01|02)*)['"><_\s:=]*(\d+([.,]\d*)*)(\s)*(<span>)*([\w$€£¥円]+)""", 7),
    (r"""\W(product_price)['"><_\s:=]*(\d+([.,]\d*)*)(\s)*(<span>)*([\w$€£¥円]+)""", 6),
    (r"""_amount__currency[><:='"\s]*([\w$€£¥円]+)""", 1),
    (r"""pricecurrency" style="display:none;">([\w$€£¥円]*)""", 1),
    (r"""currencysymbol[><:='"\s]*([\w$€£¥円]*)""", 1),
    (r"""[^:\-_?!\w](pricecol)['"\s><]*span['"\s<>]*(\D*)(\d+([.,]\d+)*)""", 2),
]
