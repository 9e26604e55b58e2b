"""Signature rules of the license scan, in order: priority, label, keyword, pattern.

Patterns are written over lower-cased words with one space between them; digits of a version
are words of their own ("2.0" is ``2 0``). A rule is tried only on texts that hold its keyword
as a word, so the keyword is a word of every alternative of its pattern; a pattern without
such a word is split into several rules. Priority 4: full grants and identifiers with a
version; 3: names with a version; 2: names; 1: general phrases. Earlier rules win ties.
"""

from __future__ import annotations

_RULES = r"""
4 apache-2.0      apache    licensed under the apache license version 2(?: 0)?
4 apache-2.0      apache    apache license version 2 0 january 2004
4 apache-2.0      apache    licensed to the apache software foundation asf under one or more contributor license agreements
3 apache-2.0      apache    apache (?:software )?license (?:version |v )?2(?: 0)?
3 apache-2.0      apache    apache (?:version |v )?2 0(?: license)?
3 apache-2.0      apachev2  apachev2
3 apache-1.1      apache    apache (?:software )?license (?:version |v )?1 1
3 apache-1.0      apache    apache (?:software )?license (?:version |v )?1 0
2 apache          apache    apache(?: software)? licen[cs]e
2 apache          apache    licensed under apache
4 mit             granted   permission is hereby granted free of charge to any person obtaining a copy of this software
4 mit-0           attribution mit no attribution
4 mit             mit       (?:released|distributed|licensed|available) under the (?:terms of the )?mit licen[cs]e
3 mit             mit       the mit licen[cs]e(?: mit)?
2 mit             mit       mit licen[cs]ed?
2 mit             expat     expat licen[cs]e
2 mit             x11       (?:mit x11|x11 mit) licen[cs]e
2 x11             x11       x11 licen[cs]e
4 gpl-3.0         gnu       licensed under the gnu general public license (?:version |v )?3(?: 0)?
4 gpl-2.0         gnu       licensed under the gnu general public license (?:version |v )?2(?: 0)?
4 gpl-3.0+        either    gnu general public license as published by the free software foundation either version 3(?: of the license)?(?: or)? at your option any later version
4 gpl-2.0+        either    gnu general public license as published by the free software foundation either version 2(?: of the license)?(?: or)? at your option any later version
4 gpl-1.0+        either    gnu general public license as published by the free software foundation either version 1(?: of the license)?(?: or)? at your option any later version
4 gpl             modify    you can redistribute it and or modify it under the terms of the gnu general public license
4 gpl-3.0+        gpl       gpl (?:v )?3(?: 0)? or later
4 gpl-2.0+        gpl       gpl (?:v )?2(?: 0)? or later
4 gpl-3.0         gpl       gpl (?:v )?3(?: 0)? only
4 gpl-2.0         gpl       gpl (?:v )?2(?: 0)? only
3 gpl-3.0         general   general public license (?:version |v )?3(?: 0)?
3 gpl-2.0         general   general public license (?:version |v )?2(?: 0)?
3 gpl-1.0         general   general public license (?:version |v )?1(?: 0)?
3 gpl-3.0         gpl       gpl (?:version |v )?3(?: 0)?
3 gpl-2.0         gpl       gpl (?:version |v )?2(?: 0)?
3 gpl-1.0         gpl       gpl (?:version |v )?1(?: 0)?
3 gpl-3.0         gplv3     gplv3
3 gpl-2.0         gplv2     gplv2
3 gpl-3.0+        gplv3     gplv3 or later
3 gpl-2.0+        gplv2     gplv2 or later
2 gpl             general   gnu general public licen[cs]e
2 gpl             general   general public licen[cs]e
2 gpl             gpl       gnu gpl
1 gpl             gpl       under the gpl
4 lgpl            modify    you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license
4 lgpl-3.0+       lgpl      lgpl (?:v )?3(?: 0)? or later
4 lgpl-2.1+       lgpl      lgpl (?:v )?2 1 or later
4 lgpl-2.0+       lgpl      lgpl (?:v )?2(?: 0)? or later
3 lgpl-3.0        lesser    lesser general public license (?:version |v )?3(?: 0)?
3 lgpl-2.1        lesser    lesser general public license (?:version |v )?2 1
3 lgpl-2.0        library   library general public license (?:version |v )?2(?: 0)?
3 lgpl-3.0        lgpl      lgpl (?:version |v )?3(?: 0)?
3 lgpl-2.1        lgpl      lgpl (?:version |v )?2 1
3 lgpl-2.0        lgpl      lgpl (?:version |v )?2 0
3 lgpl-3.0        lgplv3    lgplv3
3 lgpl-2.1        lgplv2    lgplv2(?: 1)?
2 lgpl            lesser    (?:gnu )?lesser general public licen[cs]e
2 lgpl            library   (?:gnu )?library general public licen[cs]e
2 lgpl            lgpl      gnu lgpl
1 lgpl            lgpl      under the lgpl
4 agpl-3.0+       affero    gnu affero general public license as published by the free software foundation either version 3
4 agpl-3.0+       agpl      agpl (?:v )?3(?: 0)? or later
3 agpl-3.0        affero    affero general public license (?:version |v )?3(?: 0)?
3 agpl-3.0        agpl      agpl (?:version |v )?3(?: 0)?
3 agpl-3.0        agplv3    agplv3
3 agpl-1.0        affero    affero general public license (?:version |v )?1(?: 0)?
2 agpl            affero    (?:gnu )?affero general public licen[cs]e
1 agpl            agpl      under the agpl
4 bsd-3-clause    binary    redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
4 bsd-3-clause    endorse   neither the name of (?:[^ ]+ ){1,12}?nor the names of its contributors may be used to endorse or promote products
4 bsd-4-clause    advertising all advertising materials mentioning features or use of this software must display
3 bsd-3-clause    bsd       (?:3|three) clause bsd(?: licen[cs]e)?
3 bsd-3-clause    bsd       bsd (?:3|three)(?: clause)?(?: licen[cs]e)?
3 bsd-2-clause    bsd       (?:2|two) clause bsd(?: licen[cs]e)?
3 bsd-2-clause    bsd       bsd (?:2|two)(?: clause)?(?: licen[cs]e)?
3 bsd-4-clause    bsd       (?:4|four) clause bsd(?: licen[cs]e)?
3 bsd-4-clause    bsd       bsd (?:4|four)(?: clause)?(?: licen[cs]e)?
3 bsd-1-clause    bsd       bsd (?:1|one) clause
3 0bsd            bsd       zero clause bsd(?: licen[cs]e)?
3 0bsd            0bsd      0bsd
3 bsd-3-clause    bsd       new bsd licen[cs]e
3 bsd-3-clause    bsd       modified bsd licen[cs]e
3 bsd-2-clause    bsd       simplified bsd licen[cs]e
3 bsd-2-clause    freebsd   freebsd licen[cs]e
3 bsd-4-clause    bsd       original bsd licen[cs]e
2 bsd             bsd       bsd (?:style )?licen[cs]ed?
1 bsd             bsd       under the bsd
4 isc             granted   permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
2 isc             isc       isc licen[cs]e
3 mpl-2.0         mozilla   mozilla public licen[cs]e (?:version |v )?2(?: 0)?
3 mpl-1.1         mozilla   mozilla public licen[cs]e (?:version |v )?1 1
3 mpl-1.0         mozilla   mozilla public licen[cs]e (?:version |v )?1 0
4 mpl-2.0         mozilla   this source code form is subject to the terms of the mozilla public license v 2 0
3 mpl-2.0         mpl       mpl (?:version |v )?2(?: 0)?
3 mpl-1.1         mpl       mpl (?:version |v )?1 1
2 mpl             mozilla   mozilla public licen[cs]e
3 epl-2.0         eclipse   eclipse public licen[cs]e (?:version |v )?2(?: 0)?
3 epl-1.0         eclipse   eclipse public licen[cs]e (?:version |v )?1(?: 0)?
3 epl-2.0         epl       epl (?:version |v )?2(?: 0)?
3 epl-1.0         epl       epl (?:version |v )?1(?: 0)?
2 epl             eclipse   eclipse public licen[cs]e
2 edl-1.0         eclipse   eclipse distribution licen[cs]e
3 cddl-1.1        cddl      cddl (?:version |v )?1 1
3 cddl-1.0        cddl      cddl (?:version |v )?1 0
3 cddl-1.1        distribution common development and distribution licen[cs]e (?:version |v )?1 1
3 cddl-1.0        distribution common development and distribution licen[cs]e (?:version |v )?1 0
2 cddl            distribution common development and distribution licen[cs]e
3 cpl-1.0         common    common public licen[cs]e (?:version |v )?1(?: 0)?
2 cpl             common    common public licen[cs]e
3 cpal-1.0        attribution common public attribution licen[cs]e
3 ipl-1.0         ibm       ibm public licen[cs]e
3 osl-3.0         open      open software licen[cs]e (?:version |v )?3(?: 0)?
3 osl-2.1         open      open software licen[cs]e (?:version |v )?2 1
2 osl             open      open software licen[cs]e
3 afl-3.0         academic  academic free licen[cs]e (?:version |v )?3(?: 0)?
3 afl-2.1         academic  academic free licen[cs]e (?:version |v )?2 1
2 afl             academic  academic free licen[cs]e
3 artistic-2.0    artistic  artistic licen[cs]e (?:version |v )?2(?: 0)?
3 artistic-1.0    artistic  artistic licen[cs]e (?:version |v )?1(?: 0)?
2 artistic        artistic  (?:the )?artistic licen[cs]e
3 bsl-1.0         boost     boost software licen[cs]e (?:version |v )?1(?: 0)?
2 bsl-1.0         boost     boost (?:software )?licen[cs]e
3 busl-1.1        business  business source licen[cs]e(?: 1 1)?
3 sspl-1.0        server    server side public licen[cs]e
3 elastic-2.0     elastic   elastic licen[cs]e (?:version |v )?2(?: 0)?
2 elastic         elastic   elastic licen[cs]e
4 unlicense       unencumbered this is free and unencumbered software released into the public domain
2 unlicense       unlicense (?:the )?unlicense
4 wtfpl           fuck      do what the fuck you want to public licen[cs]e
2 wtfpl           wtfpl     wtfpl
4 zlib            altered   altered source versions must be plainly marked as such
2 zlib            zlib      zlib (?:libpng )?licen[cs]e
2 libpng          libpng    libpng licen[cs]e
3 eupl-1.2        eupl      eupl (?:version |v )?1 2
3 eupl-1.1        eupl      eupl (?:version |v )?1 1
3 eupl-1.2        european  european union public licen[cs]e (?:version |v )?1 2
3 eupl-1.1        european  european union public licen[cs]e (?:version |v )?1 1
2 eupl            european  european union public licen[cs]e
3 cecill-2.1      cecill    cecill (?:version |v )?2 1
3 cecill-b        cecill    cecill b
3 cecill-c        cecill    cecill c
2 cecill          cecill    cecill(?: free software)? licen[cs]e
3 ofl-1.1         sil       sil open font licen[cs]e (?:version |v )?1 1
2 ofl             open      open font licen[cs]e
2 ofl             ofl       ofl 1 [01]
2 psf-2.0         python    python software foundation licen[cs]e
2 python          python    python licen[cs]e
2 php             php       php licen[cs]e
3 php-3.01        php       php licen[cs]e (?:version |v )?3 01
2 ruby            ruby      ruby(?: s)? licen[cs]e
2 perl            perl      under the same terms as perl(?: itself)?
2 openssl         openssl   openssl licen[cs]e
2 ssleay          ssleay    ssleay licen[cs]e
2 curl            curl      curl licen[cs]e
2 postgresql      postgresql postgresql licen[cs]e
2 vim             vim       vim licen[cs]e
2 w3c             w3c       w3c (?:software )?(?:notice and )?licen[cs]e
2 icu             icu       icu licen[cs]e
2 unicode         unicode   unicode (?:terms of use|licen[cs]e)
2 naist           naist     naist licen[cs]e
2 ncsa            ncsa      (?:university of illinois )?ncsa (?:open source )?licen[cs]e
2 upl-1.0         universal universal permissive licen[cs]e
2 ecl-2.0         educational educational community licen[cs]e
2 qpl-1.0         public    q public licen[cs]e
2 qpl-1.0         qpl       qpl
2 sleepycat       sleepycat sleepycat licen[cs]e
2 sissl           sun       sun industry standards source licen[cs]e
2 apsl            apple     apple public source licen[cs]e
3 apsl-2.0        apple     apple public source licen[cs]e (?:version |v )?2(?: 0)?
2 ms-pl           microsoft microsoft public licen[cs]e
2 ms-rl           microsoft microsoft reciprocal licen[cs]e
2 ms-pl           ms        ms pl
2 nasa-1.3        nasa      nasa open source agreement
2 lppl            latex     latex project public licen[cs]e
3 lppl-1.3c       lppl      lppl (?:version |v )?1 3c?
2 mulan-2.0       mulan     mulan (?:permissive software licen[cs]e|psl)(?: v2| version 2)?
2 blueoak-1.0     blue      blue oak model licen[cs]e
2 hpnd            historical historical permission notice and disclaimer
2 jpnic           jpnic     jpnic public licen[cs]e
2 beerware        beer      the beer ware licen[cs]e
2 beerware        beerware  beerware(?: licen[cs]e)?
2 json            evil      the software shall be used for good not evil
2 ldpl            linux     linux documentation project licen[cs]e
3 gfdl-1.3        documentation gnu free documentation licen[cs]e (?:version |v )?1 3
3 gfdl-1.2        documentation gnu free documentation licen[cs]e (?:version |v )?1 2
3 gfdl-1.1        documentation gnu free documentation licen[cs]e (?:version |v )?1 1
2 gfdl            documentation (?:gnu )?free documentation licen[cs]e
2 gfdl            gfdl      gfdl
3 odbl-1.0        database  open (?:data commons open )?database licen[cs]e
2 odbl-1.0        odbl      odbl(?: 1 0)?
2 odc-by-1.0      commons   open data commons attribution licen[cs]e
2 odc-by-1.0      odc       odc by
2 pddl-1.0        pddl      pddl
2 cdla-permissive cdla      cdla permissive(?: 2 0| 1 0)?
2 cdla-sharing    cdla      cdla sharing(?: 1 0)?
2 ogl-uk-3.0      government open government licen[cs]e(?: v3 0| v 3 0| version 3 0)?
2 etalab-2.0      etalab    etalab(?: open)?(?: licen[cs]e)?(?: 2 0)?
2 openrail        openrail  (?:creativeml )?openrail(?: m)?
2 llama           llama     llama (?:[234](?: 1| 2| 3)? )?community licen[cs]e
2 gemma           gemma     gemma terms of use
4 cc-by-nc-nd-4.0 cc        cc by nc nd 4 0
4 cc-by-nc-sa-4.0 cc        cc by nc sa 4 0
4 cc-by-nc-4.0    cc        cc by nc 4 0
4 cc-by-nd-4.0    cc        cc by nd 4 0
4 cc-by-sa-4.0    cc        cc by sa 4 0
4 cc-by-4.0       cc        cc by 4 0
4 cc-by-nc-nd-3.0 cc        cc by nc nd 3 0
4 cc-by-nc-sa-3.0 cc        cc by nc sa 3 0
4 cc-by-nc-3.0    cc        cc by nc 3 0
4 cc-by-nd-3.0    cc        cc by nd 3 0
4 cc-by-sa-3.0    cc        cc by sa 3 0
4 cc-by-3.0       cc        cc by 3 0
4 cc-by-nc-sa-2.0 cc        cc by nc sa 2 [05]
4 cc-by-nc-2.0    cc        cc by nc 2 [05]
4 cc-by-sa-2.0    cc        cc by sa 2 [05]
4 cc-by-2.0       cc        cc by 2 [05]
3 cc-by-nc-nd     cc        cc by nc nd
3 cc-by-nc-sa     cc        cc by nc sa
3 cc-by-nc        cc        cc by nc
3 cc-by-nd        cc        cc by nd
3 cc-by-sa        cc        cc by sa
2 cc-by           cc        cc by
3 cc0-1.0         cc0       cc0(?: 1 0)?(?: universal)?
3 cc0-1.0         cc        cc zero
4 cc-by-nc-nd     creative  creative commons attribution non ?commercial no ?deriv(?:ative|ation|ate)?s?
4 cc-by-nc-sa     creative  creative commons attribution non ?commercial share ?alike
4 cc-by-nc        creative  creative commons attribution non ?commercial
4 cc-by-nd        creative  creative commons attribution no ?deriv(?:ative|ation|ate)?s?
4 cc-by-sa        creative  creative commons attribution share ?alike
3 cc-by           creative  creative commons attribution
3 cc0-1.0         creative  creative commons (?:cc0|zero)
2 cc              creative  creative commons licen[cs]e
2 cc              creative  licensed under (?:a )?creative commons
4 cc-by-nc-nd     creativecommons creativecommons org licenses by nc nd
4 cc-by-nc-sa     creativecommons creativecommons org licenses by nc sa
4 cc-by-nc        creativecommons creativecommons org licenses by nc
4 cc-by-nd        creativecommons creativecommons org licenses by nd
4 cc-by-sa        creativecommons creativecommons org licenses by sa
3 cc-by           creativecommons creativecommons org licenses by
4 cc0-1.0         creativecommons creativecommons org publicdomain zero
3 pd-mark         creativecommons creativecommons org publicdomain mark
4 apache-2.0      spdx      spdx licen[cs]e identifier apache 2 0
4 mit             spdx      spdx licen[cs]e identifier mit
4 bsd-3-clause    spdx      spdx licen[cs]e identifier bsd 3 clause
4 bsd-2-clause    spdx      spdx licen[cs]e identifier bsd 2 clause
4 gpl-3.0         spdx      spdx licen[cs]e identifier gpl 3 0(?: only)?
4 gpl-3.0+        spdx      spdx licen[cs]e identifier gpl 3 0 or later
4 gpl-2.0         spdx      spdx licen[cs]e identifier gpl 2 0(?: only)?
4 gpl-2.0+        spdx      spdx licen[cs]e identifier gpl 2 0 or later
4 lgpl-3.0        spdx      spdx licen[cs]e identifier lgpl 3 0(?: only| or later)?
4 lgpl-2.1        spdx      spdx licen[cs]e identifier lgpl 2 1(?: only| or later)?
4 agpl-3.0        spdx      spdx licen[cs]e identifier agpl 3 0(?: only| or later)?
4 mpl-2.0         spdx      spdx licen[cs]e identifier mpl 2 0
4 epl-2.0         spdx      spdx licen[cs]e identifier epl 2 0
4 isc             spdx      spdx licen[cs]e identifier isc
4 unlicense       spdx      spdx licen[cs]e identifier unlicense
4 cc0-1.0         spdx      spdx licen[cs]e identifier cc0 1 0
4 bsl-1.0         spdx      spdx licen[cs]e identifier bsl 1 0
4 zlib            spdx      spdx licen[cs]e identifier zlib
2 public-domain   domain    (?:released|placed|dedicated|is) (?:in|into|to) the public domain
1 public-domain   domain    public domain
3 proprietary     rights    all rights reserved
3 proprietary     proprietary proprietary and confidential
2 proprietary     agreement end user licen[cs]e agreement
2 proprietary     unauthorized unauthorized (?:copying|reproduction|use|distribution) (?:[^ ]+ ){0,10}?prohibited
2 non-commercial  commercial for non commercial (?:use|purposes) only
2 non-commercial  noncommercial for noncommercial (?:use|purposes) only
2 non-commercial  research  for (?:academic |non commercial )?research (?:use|purposes) only
1 dual-license    dual      dual licen[cs]ed?
1 copyright       copyright copyright (?:c )?(?:19|20)\d\d
"""


def rules() -> list[tuple[int, int, str, str, str]]:
    """(order, priority, label, keyword, pattern) of each rule, with the words' borders added to the pattern."""
    out = []
    for n, line in enumerate(_RULES.strip().splitlines()):
        priority, label, keyword, pattern = line.split(None, 3)
        out.append((n, int(priority), label, keyword, f" (?:{pattern})(?= )"))
    return out
